"""Streaming extensions give the batch answers on planted data."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import rules
from fraudmart.plans.catalog import FLUSH_ROW
from fraudmart.streaming import rules as srules
from fraudmart.streaming import stateful
from fraudmart.streaming.ingest import ingest_transactions

from planted_cases import AS_OF, REPORT_DT, ids
from test_feeds import write_tx_files

FLUSH = [FLUSH_ROW]


# Two more operations within the last hour of the data: a guess chain on c7
# whose success (61) is the very last operation, so only the closing marker
# can release it.
LATE = [("60", dt.datetime(2021, 3, 3, 12, 51), "c7", "WITHDRAW", decimal.Decimal("90.00"), "REJECT", "T1"),
        ("61", dt.datetime(2021, 3, 3, 12, 55), "c7", "WITHDRAW", decimal.Decimal("80.00"), "SUCCESS", "T1")]


def _stage(spark, planted, folder):
    # One file per day, then a far-future marker that moves the watermark
    # past everything (closes the stream).
    tx = planted.transactions.unionByName(spark.createDataFrame(LATE, schemas.TRANSACTIONS))
    days = sorted({r["d"] for r in tx.select(F.to_date("trans_date").alias("d")).distinct().collect()})
    for i, d in enumerate(days):
        tx.filter(F.to_date("trans_date") == F.lit(d)).coalesce(1).write.parquet(f"{folder}/day{i}")
    spark.createDataFrame(FLUSH, schemas.TRANSACTIONS).coalesce(1).write.parquet(f"{folder}/zz-flush")
    return folder


def test_stream_rules_equal_batch(spark, planted, tmp_path):
    src = _stage(spark, planted, str(tmp_path / "src"))
    stream = srules.transaction_stream(spark, src + "/*")
    out = {}
    for name, df in {
        "passport": srules.stream_passport(planted, stream, REPORT_DT, AS_OF),
        "contract": srules.stream_contract(planted, stream, REPORT_DT),
        "any_pair": stateful.stream_city_hop_any_pair(planted, stream, REPORT_DT, AS_OF),
        "guess": stateful.stream_amount_guess(planted, stream, REPORT_DT, AS_OF),
    }.items():
        out[name] = srules.drain_to_table(spark, df, str(tmp_path / f"out-{name}"),
                                          str(tmp_path / f"ck-{name}"))
    assert out["passport"].count() == 4
    assert out["contract"].count() == 1
    assert ids(out["any_pair"]) == [10, 21, 22]
    # 61 is preceded by 60 (reject) and 43 (success): no three-reject chain,
    # only the one-reject variant below takes it.
    assert ids(out["guess"]) == [34, 55]
    batch = rules.report_rows(rules.city_hop_any_pair(planted, REPORT_DT, AS_OF)).collect()
    stream_rows = out["any_pair"].select(*schemas.REPORT_COLUMNS).collect()
    assert sorted(batch) == sorted(stream_rows)


def test_stream_releases_last_rows(spark, planted, tmp_path):
    src = _stage(spark, planted, str(tmp_path / "src"))
    stream = srules.transaction_stream(spark, src + "/*")
    one = stateful.stream_amount_guess(planted, stream, REPORT_DT, AS_OF, n_rejects=1, seconds=600)
    out = srules.drain_to_table(spark, one, str(tmp_path / "out"), str(tmp_path / "ck"))
    wh = planted.with_(transactions=planted.transactions.unionByName(
        spark.createDataFrame(LATE, schemas.TRANSACTIONS)))
    batch = rules.fraud_amount_guess(wh, REPORT_DT, AS_OF, n_rejects=1, seconds=600)
    assert 61 in ids(out)
    assert ids(out) == ids(batch)


def test_stream_ingest_exactly_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write_tx_files(landing)
    table, ck = str(tmp_path / "tx"), str(tmp_path / "ck")
    ingest_transactions(spark, landing, table, ck).awaitTermination()
    ingest_transactions(spark, landing, table, ck).awaitTermination()  # nothing new
    df = spark.read.parquet(table)
    assert df.count() == 40
    assert df.filter(F.col("trans_id") == "34").first()["amt"] == decimal.Decimal("100.00")


def test_stream_city_hop_and_report_equal_batch(spark, planted, tmp_path):
    from fraudmart.operators import report
    from fraudmart.streaming.report import start_report_stream
    src = _stage(spark, planted, str(tmp_path / "src"))
    wh = planted.with_(transactions=planted.transactions.unionByName(
        spark.createDataFrame(LATE, schemas.TRANSACTIONS)))
    for emit, expected in (("both", [9, 10, 20, 21]), ("later", [10, 21])):
        stream = srules.transaction_stream(spark, src + "/*")
        out = srules.drain_to_table(spark, stateful.stream_city_hop(planted, stream, REPORT_DT, AS_OF, emit=emit),
                                    str(tmp_path / f"hop-{emit}"), str(tmp_path / f"ck-hop-{emit}"))
        assert ids(out) == expected
    stream = srules.transaction_stream(spark, src + "/*")
    q = start_report_stream(planted, stream, str(tmp_path / "mart"), str(tmp_path / "ck-mart"), REPORT_DT, AS_OF)
    q.awaitTermination()
    mart = spark.read.parquet(str(tmp_path / "mart")).select(*schemas.REPORT_COLUMNS)
    batch = report.build_report(wh, REPORT_DT, AS_OF)
    assert sorted(mart.collect()) == sorted(batch.collect())


def test_sequence_step_scans_rules_3_and_4_together():
    # Pure scan logic, no Spark: one client, two cards, rows in order.
    def row(i, sec, card, city, result, otype, amt):
        return {"trans_id": str(i), "client_id": "c", "passport_num": "p", "fio": "f", "phone": "t",
                "ts": f"2021-03-03 00:00:{sec:02d}.000000", "sec": sec, "et": sec * 1000,
                "terminal_city": city, "oper_result": result, "oper_type": otype, "amt": amt, "card_num": card}
    rows = [row(1, 0, "a", "X", "REJECT", "WITHDRAW", "30.00"),
            row(2, 5, "b", "Y", "SUCCESS", "PAYMENT", "99.00"),
            row(3, 9, "a", "X", "SUCCESS", "WITHDRAW", "20.00"),
            row(4, 50, "b", "X", "SUCCESS", "DEPOSIT", "1.00")]
    step = stateful.sequence_rules_step(hop_seconds=10, emit="both", n_rejects=1, guess_seconds=60)
    hits, tail, live = step({}, rows)
    got = sorted((h["trans_id"], h["event_type"]) for h in hits)
    # hop: 2 (Y) next to 3 (X) within 10 s -> both; 4 is 41 s after 3 -> no.
    # guess on card a: 1 reject 30 then success 20 -> 3. Card b's 2 has no reject before it.
    assert got == sorted([("2", schemas.EVENT_CITY_HOP), ("3", schemas.EVENT_CITY_HOP),
                          ("3", schemas.EVENT_AMOUNT_GUESS)])
    assert live == (max(9 + 60, 50 + 10) + 1) * 1000


def test_stream_ingest_archives_committed_files(spark, tmp_path):
    import os
    landing, arch = tmp_path / "landing", tmp_path / "archive"
    write_tx_files(str(landing))
    table, ck = str(tmp_path / "tx"), str(tmp_path / "ck")
    ingest_transactions(spark, str(landing), table, ck, archive_dir=str(arch)).awaitTermination()
    # A new day arrives; committed files of the earlier batch are moved away.
    (landing / "transactions_04032021.txt").write_text(
        "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
        "99;2021-03-04 10:00:00;1,00;c1;PAYMENT;SUCCESS;T1\n")
    ingest_transactions(spark, str(landing), table, ck, archive_dir=str(arch)).awaitTermination()
    assert sorted(os.listdir(landing)) == ["transactions_04032021.txt"]
    archived = [f for _, _, fs in os.walk(arch) for f in fs]
    assert len(archived) == 4
    assert spark.read.parquet(table).count() == 41
