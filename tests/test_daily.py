"""The daily job end to end on planted feed files: load, report, rerun,
ledger skip, archive, export."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import report
from fraudmart.plans import staging
from fraudmart.plans.daily import run_day
from fraudmart.sources import workbook
from fraudmart.sources.store import TableStore

from planted_cases import planted_warehouse
from test_feeds import write_tx_files
from test_history import BL_EXPECTED, BL_FILES, CITY, EXPECTED, SLICES, _bl_rows, _rows


def _landing(tmp_path):
    landing = tmp_path / "landing"
    write_tx_files(str(landing))
    for day, rows in SLICES.items():
        y, m, d = day.split("-")
        blob = staging.workbook_bytes("terminals", workbook.TERMINAL_COLUMNS,
                                       [(i, t, CITY[i], a) for i, t, a in rows])
        (landing / f"terminals_{d}{m}{y}.xlsx").write_bytes(blob)
    for day, rows in BL_FILES.items():
        y, m, d = day.split("-")
        serial = [(p, (dt.date.fromisoformat(e) - dt.date(1899, 12, 30)).days) for p, e in rows
                  if p is not None]
        blob = staging.workbook_bytes("blacklist", ["passport", "date"], serial)
        (landing / f"passport_blacklist_{d}{m}{y}.xlsx").write_bytes(blob)
    return str(landing)


def test_run_day_end_to_end(spark, tmp_path):
    landing = _landing(tmp_path)
    root = str(tmp_path / "wh")
    wh = planted_warehouse(spark)
    seeds = {"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients}
    res = run_day(spark, landing, root, seeds=seeds, report_dt="2021-03-04",
                  as_of="2021-03-03 12:00:00", export_dir=str(tmp_path / "export"))
    assert res.seeded == {"cards": True, "accounts": True, "clients": True}
    assert len(res.loaded_files["transactions"]) == 4
    store = TableStore(spark, root)
    assert _rows(store.read("terminals")) == EXPECTED
    assert _bl_rows(store.read("passport_blacklist")) == BL_EXPECTED
    assert store.read("transactions").count() == 40
    mart = report.report_for_day(store, "2021-03-04")
    n = mart.count()
    assert n > 0
    expected = report.build_report(store.warehouse(), "2021-03-04", "2021-03-03 12:00:00")
    assert sorted(mart.collect()) == sorted(expected.collect())
    exported = report.read_export(spark, str(tmp_path / "export"))
    assert exported.count() == n
    assert all(os.path.basename(p) == "report_04032021.csv" for p in res.exported)

    # Same day again: nothing new to load, seeds not repeated, mart slice replaced.
    res2 = run_day(spark, landing, root, seeds=seeds, report_dt="2021-03-04",
                   as_of="2021-03-03 12:00:00")
    assert res2.seeded == {"cards": False, "accounts": False, "clients": False}
    assert all(v == [] for v in res2.loaded_files.values())
    assert report.report_for_day(store, "2021-03-04").count() == n
    assert store.read("cards").count() == wh.cards.count()

    # Next day: the whole history is reported again under the new date.
    run_day(spark, landing, root, report_dt="2021-03-05", as_of="2021-03-03 12:00:00")
    all_days = store.read("reporting_list").groupBy("report_dt").count().orderBy("report_dt").collect()
    assert [(r["report_dt"], r["count"]) for r in all_days] == [
        (dt.date(2021, 3, 4), n), (dt.date(2021, 3, 5), n)]
    # Partition pruning reaches the scan.
    plan = report.report_for_day(store, "2021-03-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "report_dt" in plan


def test_archive_moves_processed_files(spark, tmp_path):
    landing = _landing(tmp_path)
    root = str(tmp_path / "wh")
    wh = planted_warehouse(spark)
    seeds = {"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients}
    run_day(spark, landing, root, seeds=seeds, report_dt="2021-03-04",
            archive_dir=str(tmp_path / "archive"))
    assert sorted(os.listdir(landing)) == []
    assert len(os.listdir(tmp_path / "archive")) == 10
    # Transactions of a day stay loaded after the archive.
    assert TableStore(spark, root).read("transactions").filter(
        F.col("load_dt") == F.lit("2021-03-03").cast("date")).count() == 32
    assert sorted(TableStore(spark, root).read("reporting_list").columns) == sorted(schemas.REPORT_COLUMNS)


def test_command_line_run_day(spark, tmp_path):
    from fraudmart.__main__ import main
    landing = _landing(tmp_path)
    wh = planted_warehouse(spark)
    seeds = tmp_path / "seed"
    for name in ("cards", "accounts", "clients"):
        getattr(wh, name).write.parquet(str(seeds / f"{name}.parquet"))
    assert main(["run-day", "--landing", landing, "--root", str(tmp_path / "wh"), "--seeds", str(seeds),
                 "--report-dt", "2021-03-04", "--as-of", "2021-03-03 12:00:00",
                 "--export", str(tmp_path / "out")]) == 0
    assert report.read_export(spark, str(tmp_path / "out")).count() > 0


def test_loading_does_not_depend_on_session_zone(spark, tmp_path):
    from fraudmart.plans.daily import load_transactions
    landing = _landing(tmp_path)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        store = TableStore(spark, str(tmp_path / "wh"))
        assert len(load_transactions(spark, store, landing).paths) == 4
        assert store.read("transactions").count() == 40
        row = store.read("transactions").filter(F.col("trans_id") == "1").first()
        assert row["trans_date"] == dt.datetime(2021, 2, 28, 23, 59, 59)
        assert row["load_dt"] == dt.date(2021, 2, 28)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rule_filters_and_columns_reach_the_parquet_scan(spark, tmp_path):
    from fraudmart.operators import rules
    landing = _landing(tmp_path)
    root = str(tmp_path / "wh")
    wh = planted_warehouse(spark)
    run_day(spark, landing, root, seeds={"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients},
            report_dt="2021-03-04")
    stored = TableStore(spark, root).warehouse()

    def scan_of(df, table):
        old = spark.conf.get("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # no "..." in plans
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.maxMetadataStringLength", old)
        return [l for l in plan.splitlines()
                if "FileScan parquet" in l and (f"/{table}]" in l or f"/{table}/v=" in l)]

    contract = rules.fraud_contract(stored, "2021-03-04")
    tx_scan = scan_of(contract, "transactions")
    assert tx_scan and all("EqualTo(oper_result,SUCCESS)" in l for l in tx_scan)
    # Only the columns the rule needs are read from the fact.
    assert all("amt" not in l.split("ReadSchema:")[1] and "oper_type" not in l.split("ReadSchema:")[1]
               for l in tx_scan)
    guess = rules.fraud_amount_guess(stored, "2021-03-04", "2021-03-03 12:00:00")
    g_scan = scan_of(guess, "transactions")
    assert g_scan and all("In(oper_type" in l for l in g_scan)
    term = scan_of(guess, "terminals")
    assert term and all("deleted_flg" in l.split("PushedFilters:")[1] for l in term)


def test_run_day_since_reports_only_new_events(spark, tmp_path):
    landing = _landing(tmp_path)
    root = str(tmp_path / "wh")
    wh = planted_warehouse(spark)
    seeds = {"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients}
    run_day(spark, landing, root, seeds=seeds, report_dt="2021-03-04", as_of="2021-03-03 12:00:00",
            since="2021-03-03 00:00:00")
    store = TableStore(spark, root)
    mart = report.report_for_day(store, "2021-03-04")
    full = report.build_report(store.warehouse(), "2021-03-04", "2021-03-03 12:00:00")
    want = full.filter(F.col("event_dt") >= F.lit("2021-03-03 00:00:00").cast("timestamp_ntz"))  # no pair crosses it
    assert sorted(mart.collect()) == sorted(want.collect())
    assert mart.count() < full.count()


def test_unparsable_amounts_are_kept_and_counted(spark, tmp_path):
    landing = _landing(tmp_path)
    with open(os.path.join(landing, "transactions_05032021.txt"), "w") as f:
        f.write("transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
                "70;2021-03-05 10:00:00;1 234,5;c1;PAYMENT;SUCCESS;T1\n"
                "71;2021-03-05 10:01:00;12,50;c1;PAYMENT;SUCCESS;T1\n")
    wh = planted_warehouse(spark)
    res = run_day(spark, landing, str(tmp_path / "wh"),
                  seeds={"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients},
                  report_dt="2021-03-06")
    assert res.rejects == {"transactions": 1, "terminals": 0, "passport_blacklist": 0}
    tx = TableStore(spark, str(tmp_path / "wh")).read("transactions")
    assert tx.count() == 42
    assert tx.filter(F.col("trans_id") == "70").first()["amt"] is None
