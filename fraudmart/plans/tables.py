"""Registered queries of the named tables, SQL rules, sorted merge, bucketed fact and
bucketed history, and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import chain, rules
from fraudmart.plans import catalog, daily, lens, oracle
from fraudmart.session import scratch_path
from fraudmart.sources import feeds, sqltables
from fraudmart.sources.bucketed import append_bucketed, bucketed_fact
from fraudmart.sources.buckets import BucketedHistory
from fraudmart.sources.store import TableStore

AS_OF, REPORT_DT = lens.AS_OF, lens.REPORT_DT
KEYS, ATTRS = ["terminal_id", "terminal_type"], ["terminal_city", "terminal_address"]


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def _database(spark, sf_dir) -> str:
    """A database of its own with the shared rows, inserted without the columns that
    have defaults where the binding allows it."""
    db, wh = _name("bank"), lens.warehouse(spark, sf_dir)
    sqltables.create_all(spark, db, scratch_path(spark, "bank"))
    for t in ("cards", "accounts", "clients", "transactions"):
        sqltables.insert(spark, db, t, getattr(wh, t))
    for t in ("terminals", "passport_blacklist"):
        rows = getattr(wh, t)
        sqltables.insert(spark, db, t, rows, [c for c in rows.columns if c not in ("effective_to", "deleted_flg")])
    spark.sql(f"SET VARIABLE {sqltables.AS_OF} = TIMESTAMP_NTZ '{AS_OF}'")
    return db


def catalog_defaults(spark, sf_dir):
    """Rows inserted without the defaulted columns, seen through the view."""
    db = _database(spark, sf_dir)
    return spark.sql("SELECT t.terminal_id, v.terminal_city, t.effective_from, t.effective_to, t.deleted_flg "
                     f"FROM {db}.terminals t JOIN v_terminals v ON v.terminal_id = t.terminal_id")


def catalog_views(spark, sf_dir):
    _database(spark, sf_dir)
    return spark.sql(
        "SELECT t.trans_id, c.client_id, te.terminal_id, te.terminal_type, te.terminal_city FROM v_transactions t "
        "JOIN v_cards k ON k.card_num = t.card_num JOIN v_accounts a ON a.account = k.account "
        "JOIN v_clients c ON c.client_id = a.client JOIN v_terminals te ON te.terminal_id = t.terminal")


def _rule(name: str, with_as_of: bool = True):
    def q(spark, sf_dir):
        _database(spark, sf_dir)
        args = f"DATE '{REPORT_DT}'" + (f", TIMESTAMP_NTZ '{AS_OF}'" if with_as_of else "")
        return spark.sql(f"SELECT * FROM {name}({args})")
    return q


def sql_fraud_amount_guess_dense(spark, sf_dir):
    db = _database(spark, sf_dir)
    spark.sql(f"TRUNCATE TABLE {db}.transactions")
    sqltables.insert(spark, db, "transactions", lens.dense_transactions(spark, sf_dir))
    return spark.sql(f"SELECT * FROM fraud_amount_guess(DATE '{REPORT_DT}', TIMESTAMP_NTZ '{AS_OF}')")


def _with_history(spark, sf_dir):
    return lens.warehouse(spark, sf_dir).with_(terminals=catalog.scd2_terminal_history(spark, sf_dir))


def chain_terminal_as_of_merge(spark, sf_dir):
    """D9 by sorted merge."""
    wh = _with_history(spark, sf_dir)
    return chain.with_terminal_as_of(chain.v_transactions(wh), wh.terminals).select(
        "trans_id", *KEYS, *ATTRS)


def city_hop_point_in_time_merge(spark, sf_dir):
    return rules.report_rows(rules.fraud_city_hop(_with_history(spark, sf_dir), REPORT_DT, AS_OF, point_in_time="merge"))


def ownership_chain_bucketed(spark, sf_dir):
    """J1 over the bucketed fact, as it runs when the owners are too many to broadcast."""
    wh, table = lens.warehouse(spark, sf_dir), _name("fact")
    append_bucketed(wh.transactions, table, scratch_path(spark, "bucketed"), buckets=16)
    rows = chain.ownership_chain(wh, bucketed_fact(spark, table), wh.owners.hint("merge"))
    return rows.select("trans_id", "card_num", "account", "client_id")


def terminals_by_bucket(spark, sf_dir):
    """Three slices loaded out of order and one twice into the bucketed history."""
    table = BucketedHistory(spark, scratch_path(spark, "history"), KEYS, ATTRS, schemas.TERMINALS, buckets=8)
    slices = lens.terminal_slices(spark, sf_dir)
    for day in ("2024-01-02", "2024-01-03", "2024-01-01", "2024-01-02"):
        table.load(slices.filter(F.to_date("effective_from") == day))
    return table.read()


def feed_rejects(spark, sf_dir):
    """Feed files in which some lines have a wrong amount, a wrong time or a wrong
    number of fields, loaded; what the load kept aside."""
    base, i = scratch_path(spark, "badfeed"), F.col("transaction_id").cast("long")
    feed = feeds.to_feed_text(lens.transactions(spark, sf_dir)).withColumns({
        "amount": F.when(i % 40 == 1, "1 234,5x").otherwise(F.col("amount")),
        "transaction_date": F.when(i % 40 == 2, "soon").otherwise(F.col("transaction_date"))})
    names = schemas.TX_FEED.fieldNames()
    line = F.concat_ws(";", *names)
    lines = feed.select(F.col("_feed_day"), F.lit(1).alias("at"), F.when(i % 40 == 3, F.concat_ws(";", *names[:4]))
                        .when(i % 40 == 4, F.concat(line, F.lit(";more"))).otherwise(line).alias("value"))
    heads = lines.select("_feed_day").distinct().select("_feed_day", F.lit(0).alias("at"), F.lit(";".join(names)).alias("value"))
    (lines.unionByName(heads).repartition("_feed_day").sortWithinPartitions("_feed_day", "at").drop("at")
     .write.partitionBy("_feed_day").text(f"{base}/staging"))
    feeds.publish(spark, f"{base}/staging", f"{base}/landing", "transactions", "txt")
    store = TableStore(spark, f"{base}/wh")
    daily.load_transactions(spark, store, f"{base}/landing")
    return store.read("_rejects").select("line", "reason")


QUERIES = {
    "catalog_defaults": catalog_defaults,
    "catalog_views": catalog_views,
    "sql_fraud_passport": _rule("fraud_passport"),
    "sql_fraud_contract": _rule("fraud_contract", with_as_of=False),
    "sql_fraud_city_hop": _rule("fraud_city_hop"),
    "sql_fraud_amount_guess_dense": sql_fraud_amount_guess_dense,
    "chain_terminal_as_of_merge": chain_terminal_as_of_merge,
    "city_hop_point_in_time_merge": city_hop_point_in_time_merge,
    "ownership_chain_bucketed": ownership_chain_bucketed,
    "terminals_by_bucket": terminals_by_bucket,
    "feed_rejects": feed_rejects,
}

SQL = {
    "catalog_defaults": oracle._q(
        "SELECT terminal_id, terminal_city, TIMESTAMP '2024-01-01 00:00:00' AS effective_from, "
        "TIMESTAMP '9999-12-31 23:59:59' AS effective_to, 0 AS deleted_flg FROM l_terminals"),
    "catalog_views": oracle.SQL["chain_with_terminal"],
    "sql_fraud_passport": oracle.SQL["fraud_passport"],
    "sql_fraud_contract": oracle.SQL["fraud_contract"],
    "sql_fraud_city_hop": oracle.SQL["fraud_city_hop"],
    "sql_fraud_amount_guess_dense": oracle.SQL["fraud_amount_guess_dense"],
    "chain_terminal_as_of_merge": oracle.SQL["chain_terminal_at_event_time"],
    "city_hop_point_in_time_merge": oracle.SQL["city_hop_point_in_time"],
    "ownership_chain_bucketed": oracle.SQL["ownership_chain"],
    "terminals_by_bucket": oracle.SQL["scd2_terminal_history"],
    "feed_rejects": oracle._q(
        "SELECT CASE WHEN i % 40 = 3 THEN a WHEN i % 40 = 4 THEN a || b || ';more' ELSE a || b END AS line, "
        "CASE i % 40 WHEN 1 THEN 'amount' WHEN 2 THEN 'time' ELSE 'fields' END AS reason FROM (SELECT *, "
        "trans_id || ';' || CASE WHEN i % 40 = 2 THEN 'soon' ELSE strftime(trans_date, '%Y-%m-%d %H:%M:%S') END || ';' || "
        "CASE WHEN i % 40 = 1 THEN '1 234,5x' ELSE replace(CAST(amt AS VARCHAR), '.', ',') END || ';' || card_num AS a, "
        "';' || oper_type || ';' || oper_result || ';' || terminal AS b "
        "FROM (SELECT *, CAST(trans_id AS BIGINT) AS i FROM l_tx)) WHERE i % 40 BETWEEN 1 AND 4"),
}
