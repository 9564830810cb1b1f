"""Named tables and SQL rules, as-of merge and the bucketed fact on planted rows."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import chain, rules
from fraudmart.operators.asof import asof_join
from fraudmart.sources import sqltables
from fraudmart.sources.bucketed import append_bucketed, bucketed_fact
from planted_cases import AS_OF, REPORT_DT, TS


@pytest.fixture
def bank(spark, planted, tmp_path):
    db = f"bank_{uuid.uuid4().hex[:8]}"
    sqltables.create_all(spark, db, str(tmp_path / "bank"))
    for t in ("cards", "accounts", "clients", "transactions", "passport_blacklist", "terminals"):
        sqltables.insert(spark, db, t, getattr(planted, t))
    return db


def test_rules_from_sql(spark, planted, bank):
    both = f"DATE '{REPORT_DT}', TIMESTAMP_NTZ '{AS_OF}'"
    for name, args, df in (("fraud_passport", both, rules.fraud_passport(planted, REPORT_DT, AS_OF)),
                           ("fraud_contract", f"DATE '{REPORT_DT}'", rules.fraud_contract(planted, REPORT_DT)),
                           ("fraud_city_hop", both, rules.fraud_city_hop(planted, REPORT_DT, AS_OF)),
                           ("fraud_amount_guess", both, rules.fraud_amount_guess(planted, REPORT_DT, AS_OF))):
        want = sorted(rules.report_rows(df).collect())
        assert sorted(spark.sql(f"SELECT * FROM {name}({args})").collect()) == want and want
    one = spark.sql(f"SELECT count(*) FROM fraud_city_hop({both}) h JOIN v_clients c ON c.passport_num = h.passport").first()[0]
    assert one == 4  # a function's rows join like a table's


def test_defaults_and_the_instant(spark, bank):
    spark.sql(f"INSERT INTO {bank}.terminals (terminal_id, terminal_type) VALUES ('N1', 'ATM')")
    spark.sql(f"INSERT INTO {bank}.cards (card_num, account) VALUES ('n1', 'a1')")
    r = spark.sql(f"SELECT * FROM {bank}.terminals WHERE terminal_id = 'N1'").first()
    assert r["effective_to"] == TS(schemas.OPEN_END) and r["deleted_flg"] == 0 and r["effective_from"] is not None
    assert spark.sql(f"SELECT create_dt IS NOT NULL AND update_dt IS NULL FROM {bank}.cards WHERE card_num = 'n1'").first()[0]
    known = lambda: {r[0] for r in spark.sql("SELECT terminal_id FROM v_terminals").collect()}
    assert known() == {"T1", "T2", "T3", "N1"}  # no instant set: now
    spark.sql(f"SET VARIABLE fraud_as_of = TIMESTAMP_NTZ '{AS_OF}'")
    assert known() == {"T1", "T2", "T3"}
    spark.sql("SET VARIABLE fraud_as_of = TIMESTAMP_NTZ '2001-01-01 00:00:00'")
    assert known() == set()
    sqltables.create_tables(spark, bank)  # again: nothing is lost
    assert spark.sql(f"SELECT count(*) FROM {bank}.terminals").first()[0] == 4


def plain_asof(rows, starts):
    out = []
    for i, k, t in rows:
        best = max(((s, v) for kk, s, v in starts if k is not None and t is not None and kk == k and s <= t), default=None)
        out.append((i, k, t, best[1] if best else None))
    return out


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_asof_equals_plain_over_hot_and_idle_keys(spark, parts):
    rnd = random.Random(parts)
    key = lambda: rnd.choice(["hot"] * 6 + ["a", "b", "c", None])
    rows = [(i, key(), rnd.choice([rnd.randint(0, 400), None, 200])) for i in range(600)]
    starts = [(k, s, f"{k}{s}") for k in ("hot", "b", "d") for s in rnd.sample(range(0, 400), 40 if k == "hot" else 3)]
    starts.append(("c", 399, "c399"))  # begins after nearly everything
    left = spark.createDataFrame(rows, "id long, k string, t long")
    right = spark.createDataFrame([*starts, (None, 1, "x")], "k string, s long, v string")
    got = asof_join(left, right, ["k"], "t", "s", ["v"], partitions=parts).collect()
    order = lambda r: r[0]
    assert sorted((tuple(r) for r in got), key=order) == sorted(plain_asof(rows, starts), key=order)


def test_asof_terminals_with_many_changes_multiply_nothing(spark, planted):
    history = spark.createDataFrame(
        [("T1", "ATM", f"city{d % 2}", "a", TS(f"2021-02-{d:02d}"), TS(f"2021-02-{d:02d} 23:59:59"), 0) for d in range(1, 29)]
        + [("T1", "ATM", "city0", "a", TS("2021-03-01"), TS(schemas.OPEN_END), 0),
           ("T2", "POS", "Kazan", "a", TS("2021-03-01"), TS("2021-03-03 10:04:59"), 0),
           ("T2", "ATM", "Kazan", "a", TS("2021-03-03 10:00:00"), TS(schemas.OPEN_END), 0),
           ("T3", "ATM", "gone", "a", TS("2021-03-01"), TS(schemas.OPEN_END), 1)], schemas.TERMINALS)
    tx = chain.v_transactions(planted)
    cols = ["trans_id", "terminal_id", "terminal_type", "terminal_city"]
    want = chain.with_terminal_at_event(tx, history).select(*cols)
    got = chain.with_terminal_as_of(tx, history, partitions=5).select(*cols)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 30
    merged = spark.createDataFrame([], schemas.TERMINALS)
    assert chain.with_terminal_as_of(tx, merged).count() == 0
    hop = [sorted(rules.report_rows(rules.fraud_city_hop(planted.with_(terminals=history), REPORT_DT, AS_OF, point_in_time=p)).collect())
           for p in (True, "merge")]
    assert hop[0] == hop[1]


def test_bucketed_fact_is_not_shuffled(spark, planted, tmp_path):
    table = f"fact_{uuid.uuid4().hex[:8]}"
    half = F.col("trans_id").cast("int") % 2 == 0
    for part in (planted.transactions.filter(half), planted.transactions.filter(~half)):
        append_bucketed(part, table, str(tmp_path / "fact"), buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = chain.ownership_chain(planted, bucketed_fact(spark, table))
        plan = bucketed._jdf.queryExecution().executedPlan().toString()
        rows = sorted(r["trans_id"] for r in bucketed.select("trans_id").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan[plan.index("SortMergeJoin"):]  # the fact's join comes first, its side before the owners'
    fact = join[:join.index("FileScan parquet")]
    assert "Exchange" not in fact and "Bucketed: true" in plan
    assert rows == sorted(r["trans_id"] for r in chain.ownership_chain(planted).select("trans_id").collect())
