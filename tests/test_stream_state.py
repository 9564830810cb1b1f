"""Interval join, typed state and quarantine on planted rows."""

from __future__ import annotations

import decimal

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import report, rules
from fraudmart.plans.catalog import FLUSH_ROW
from fraudmart.streaming import interval, quarantine, stateful, typed
from fraudmart.streaming import rules as srules

from planted_cases import AS_OF, REPORT_DT, TS, ids, planted_warehouse


def rows(spark, *found):
    return spark.createDataFrame(list(found), schemas.TRANSACTIONS)


def op(i, ts, card="c1", kind="PAYMENT", amt="10.00", result="SUCCESS", terminal="T1"):
    return (str(i), TS(ts) if ts else None, card, kind, decimal.Decimal(amt) if amt else None, result, terminal)


def arrive(spark, folder, slices, build, flush=True):
    """Drain the slices one by one, each in a run of its own."""
    flush_row = [rows(spark, FLUSH_ROW)] if flush else []
    for i, part in enumerate([*slices, *flush_row]):
        part.coalesce(1).write.parquet(f"{folder}/src/slice{i}")
        stream = srules.transaction_stream(spark, f"{folder}/src/*")
        out = srules.drain_to_table(spark, build(stream), f"{folder}/out", f"{folder}/ck")
    return out


def by_day(planted):
    day = F.to_date("trans_date")
    return [planted.transactions.filter(day < "2021-03-03"), planted.transactions.filter(day >= "2021-03-03")]


NULLS = [op("n1", None), op("n2", None, "c7", "WITHDRAW"), op("n3", None, "c5a", "WITHDRAW", None, "REJECT")]


def test_null_times_do_not_stop_rules_3_and_4(spark, planted, tmp_path):
    slices = [p.unionByName(rows(spark, *NULLS)) for p in by_day(planted)]
    for name, build, expected in (
            ("guess", stateful.stream_amount_guess, [34, 55]), ("any", stateful.stream_city_hop_any_pair, [10, 21, 22]),
            ("typed", typed.stream_amount_guess_typed, [34, 55]), ("hop", typed.stream_city_hop_typed, [10, 21, 22])):
        out = arrive(spark, str(tmp_path / name), slices, lambda s: build(planted, s, REPORT_DT, AS_OF))
        assert ids(out) == expected, name


def test_interval_join_equals_batch_over_restarts(spark, planted, tmp_path):
    more = rows(spark, op(70, "2021-03-03 23:40:00", "c9"), op(71, "2021-03-04 00:10:00", "c9", terminal="T2"),
                op(72, "2021-03-04 00:10:00", "c9"), *NULLS)
    slices = [*by_day(planted), more.filter("trans_id = '70'"), more.filter("trans_id <> '70'")]
    wh = planted.with_(transactions=planted.transactions.unionByName(more))
    for emit in ("later", "both"):
        for width in (3600, 43200):
            out = arrive(spark, str(tmp_path / f"{emit}{width}"), slices, lambda s: interval.stream_city_hop_interval_join(
                planted, s, REPORT_DT, AS_OF, emit=emit, bucket_seconds=width), flush=False)
            batch = rules.city_hop_any_pair(wh, REPORT_DT, AS_OF, emit=emit)
            assert ids(out) == ids(batch) and 71 in ids(out) and (70 in ids(out)) == (emit == "both")


def test_interval_join_forgets(spark, planted, tmp_path):
    """Operations the watermark has left behind leave the state of the join."""
    base = str(tmp_path)
    for i, hour in enumerate((0, 5, 10, 15, 20)):
        rows(spark, *[op(100 * i + k, f"2021-03-05 {hour:02d}:{k:02d}:00", terminal="T2") for k in range(20)]) \
            .coalesce(1).write.parquet(f"{base}/src/slice{i}")
        stream = srules.transaction_stream(spark, f"{base}/src/*")
        q = (interval.stream_city_hop_interval_join(planted, stream, REPORT_DT, AS_OF, delay="10 minutes")
             .writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        held = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert held <= 40  # both sides of the last slice at most, not of all five


def test_typed_state_takes_up_where_the_fact_ends(spark, planted, tmp_path):
    """A chain that begins in the stored fact and ends in the stream."""
    old = rows(spark, *[op(200 + k, f"2021-03-04 10:0{k}:00", "c9", "WITHDRAW", f"{90 - k}.00", "REJECT") for k in range(3)],
               op(210, "2021-03-04 10:04:00", "c6", terminal="T2"))
    new = rows(spark, op(203, "2021-03-04 10:05:00", "c9", "WITHDRAW", "80.00"), op(211, "2021-03-04 10:30:00", "c6"))
    known = planted.with_(transactions=planted.transactions.unionByName(old))
    for build, state, expected in ((typed.stream_amount_guess_typed, typed.guess_state, [203]),
                                   (typed.stream_city_hop_typed, typed.hop_state, [211])):
        for with_state in (True, False):
            out = arrive(spark, str(tmp_path / f"{build.__name__}{with_state}"), [new], lambda s: build(
                known, s, REPORT_DT, AS_OF, initial=state(known, AS_OF) if with_state else None))
            assert ids(out) == (expected if with_state else [])


def test_watched_report_keeps_and_repairs(spark, planted, tmp_path):
    day = F.to_date("trans_date")
    tx = planted.transactions
    held_back = ["10", "32", "33", "41"]  # arrive a day late: a hop, a break and a link of guess chains
    after = rows(spark, op(300, "2021-03-04 12:00:00", "c1"), op(301, "2021-03-04 12:10:00", "c1", terminal="T2"))
    slices = [tx.filter((day <= "2021-03-03") & ~F.col("trans_id").isin(held_back)), after.filter("trans_id = '300'"),
              tx.filter(F.col("trans_id").isin(held_back)).unionByName(after.filter("trans_id = '301'"))
              .unionByName(rows(spark, *NULLS, op("a1", "2021-03-04 12:20:00", "c1", amt=None))), rows(spark, FLUSH_ROW)]
    whole = planted.with_(transactions=tx.unionByName(after).unionByName(
        rows(spark, *NULLS, op("a1", "2021-03-04 12:20:00", "c1", amt=None))))
    base = str(tmp_path)
    for i, part in enumerate(slices):
        part.coalesce(1).write.parquet(f"{base}/src/slice{i}")
        quarantine.start_watched_report(planted, srules.transaction_stream(spark, f"{base}/src/*"), f"{base}/report",
                                        f"{base}/ck", REPORT_DT, AS_OF).awaitTermination()
    kept = sorted((r["reason"], r["trans_id"]) for r in quarantine.quarantined(spark, f"{base}/report").collect())
    assert kept == sorted([("late", i) for i in held_back] + [("no time", i) for i in ("n1", "n2", "n3")]
                          + [("no amount", "a1")])
    full = sorted(report.build_report(whole, REPORT_DT, AS_OF).collect())
    streamed = sorted(quarantine.streamed_events(spark, f"{base}/report").select(*schemas.REPORT_COLUMNS).collect())
    repaired = sorted(quarantine.repaired_report(whole, f"{base}/report", REPORT_DT, AS_OF).collect())
    assert repaired == full and streamed != full


def test_a_repeated_batch_replaces_itself(spark, planted, tmp_path):
    write = quarantine._write_batch(f"{tmp_path}/batches", f"{tmp_path}/marks", "1 hour")

    def batch(*found):
        return rows(spark, *found).withColumns({"kind": F.lit("row"), "arrived_time": F.timestamp_seconds(
            F.unix_timestamp("trans_date"))}).withColumns({c: F.lit(None).cast(schemas.REPORT[c].dataType if c in schemas.REPORT_COLUMNS
                                                                               else schemas.TS) for c in quarantine.EVENT_COLUMNS})

    write(batch(op(1, "2021-03-03 10:00:00")), 0)
    for _ in range(2):  # the second run is the same batch after a crash
        write(batch(op(2, "2021-03-03 09:00:00"), op(3, "2021-03-03 09:00:01"), op(4, "2021-03-05 00:00:00")), 1)
    assert [(r["trans_id"], r["reason"], r["batch"]) for r in quarantine.quarantined(spark, str(tmp_path)).collect()] == [
        ("2", "late", 1)]


def test_nothing_streamed_yet(spark, planted, tmp_path):
    assert quarantine.quarantined(spark, str(tmp_path / "none")).count() == 0
    assert quarantine.repaired_report(planted, str(tmp_path / "none"), REPORT_DT, AS_OF).count() == 0


def test_any_pair_both_over_bucket_edges(spark, planted):
    found = rows(spark, op(1, "2021-03-05 11:59:50"), op(2, "2021-03-05 12:00:10", terminal="T2"),
                 op(3, "2021-03-05 13:00:10"), op(4, "2021-03-05 14:00:11", terminal="T2"))
    wh = planted.with_(transactions=found)
    for width in (3600, 43200):
        assert ids(rules.city_hop_any_pair(wh, REPORT_DT, AS_OF, bucket_seconds=width, emit="both")) == [1, 2, 3]
        assert ids(rules.city_hop_any_pair(wh, REPORT_DT, AS_OF, bucket_seconds=width)) == [2, 3]




PLAIN_SESSION = """
import sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark.sql import SparkSession
from fraudmart.streaming import rules as srules, typed
from planted_cases import AS_OF, REPORT_DT, ids, planted_warehouse
spark = SparkSession.builder.master("local[2]").config(map={{
    "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": {base!r} + "/shared"}}).getOrCreate()
store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
wh = planted_warehouse(spark)
for name, build in (("guess", typed.stream_amount_guess_typed), ("hop", typed.stream_city_hop_typed)):
    stream = srules.transaction_stream(spark, {base!r} + "/src/*")
    out = srules.drain_to_table(spark, build(wh, stream, REPORT_DT, AS_OF), {base!r} + "/" + name, {base!r} + "/ck-" + name)
    print("found", name, ids(out))
assert store == spark.conf.get("spark.sql.streaming.stateStore.providerClass")
"""


def test_typed_state_in_a_plain_session_elsewhere(spark, planted, tmp_path):
    """Neither the working folder nor the session's settings are those of this library."""
    import os
    import subprocess
    import sys
    base, tests = str(tmp_path), os.path.dirname(os.path.abspath(__file__))
    for i, part in enumerate([planted.transactions, rows(spark, FLUSH_ROW)]):
        part.coalesce(1).write.parquet(f"{base}/src/slice{i}")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    code = PLAIN_SESSION.format(repo=os.path.dirname(tests), tests=tests, base=base)
    done = subprocess.run([sys.executable, "-c", code], cwd=base, env=env, capture_output=True, text=True, timeout=300)
    found = [line for line in done.stdout.splitlines() if line.startswith("found")]
    assert found == ["found guess [34, 55]", "found hop [10, 21, 22]"], done.stderr[-3000:]


def test_state_does_not_grow_with_the_number_of_keys(spark, tmp_path):
    """Waiting operations of 3000 clients: one state row per group of keys, not per
    key, and the events of rules 3 and 4 are the batch rules'."""
    from fraudmart.warehouse import Warehouse
    n, k = 3000, F.col("id").cast("string")
    null = F.lit(None).cast("date")
    made = spark.range(n)
    wh = Warehouse(
        clients=made.select(k.alias("client_id"), k.alias("last_name"), k.alias("first_name"), k.alias("patronymic"),
                            null.alias("date_of_birth"), k.alias("passport_num"), null.alias("passport_valid_to"),
                            k.alias("phone"), null.alias("create_dt"), null.alias("update_dt")),
        accounts=made.select(k.alias("account"), null.alias("valid_to"), k.alias("client"), null.alias("create_dt"),
                             null.alias("update_dt")),
        cards=made.select(k.alias("card_num"), k.alias("account"), null.alias("create_dt"), null.alias("update_dt")),
        terminals=planted_warehouse(spark).terminals, passport_blacklist=None, transactions=None)
    at, i = F.col("at"), F.col("id")
    tx = made.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        F.concat_ws("-", "id", "at").alias("trans_id"),
        (F.lit("2021-03-03 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=at * (1 + i % 5 * 20))).alias("trans_date"),
        k.alias("card_num"), F.lit("WITHDRAW").alias("oper_type"), (F.lit(90) - at * (i % 3)).cast(schemas.AMOUNT).alias("amt"),
        F.when((at == 2) | (i % 2 == 0), "SUCCESS").otherwise("REJECT").alias("oper_result"),
        F.when(at == 1, "T2").otherwise("T1").alias("terminal"))
    wh = wh.with_(transactions=tx)
    kw = {"n_rejects": 2, "seconds": 3600}
    for name, build, batch in (
            ("hop", stateful.stream_city_hop, rules.fraud_city_hop(wh, REPORT_DT, AS_OF)),
            ("guess", lambda *a: stateful.stream_amount_guess(*a, **kw), rules.fraud_amount_guess(wh, REPORT_DT, AS_OF, **kw))):
        base = str(tmp_path / name)
        tx.coalesce(1).write.parquet(f"{base}/src/slice0")
        stream = srules.transaction_stream(spark, f"{base}/src/*")
        q = (build(wh, stream, REPORT_DT, AS_OF).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        held = max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress)
        assert 0 < held <= stateful.GROUPS < n
        rows(spark, FLUSH_ROW).write.parquet(f"{base}/src/slice1")
        stream = srules.transaction_stream(spark, f"{base}/src/*")
        out = srules.drain_to_table(spark, build(wh, stream, REPORT_DT, AS_OF), f"{base}/out", f"{base}/ck")
        found = sorted(r["trans_id"] for r in out.collect())
        assert found == sorted(r["trans_id"] for r in batch.collect()) and len(found) > 100
