"""Late files, reruns, rejected files and changed inputs of the daily job."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import chain, history, report
from fraudmart.plans import daily, staging
from fraudmart.sources import feeds, files, workbook
from fraudmart.sources.store import TableStore

from planted_cases import TS, D, planted_warehouse
from test_history import ATTRS, BL_SCHEMA, KEYS, SLICE_SCHEMA, _bl_rows

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def feed(folder, name, *rows, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(header + "".join(r + "\n" for r in rows))


def row(i, at="2021-03-01 10:00:00"):
    return f"{i};{at};1,00;c1;PAYMENT;SUCCESS;T1"


def ids(store):
    return sorted(int(r["trans_id"]) for r in store.read("transactions").collect())


def test_late_file_of_an_archived_day(spark, tmp_path):
    landing, root, arch = str(tmp_path / "in"), str(tmp_path / "wh"), str(tmp_path / "arch")
    store = TableStore(spark, root)
    feed(landing, "transactions_01032021.txt", row(1), row(2))
    run = lambda: daily.run_day(spark, landing, root, report_dt="2021-03-04", archive_dir=arch)
    assert len(run().loaded_files["transactions"]) == 1
    feed(landing, "transactions_01032021.txt", row(3))  # the same name, a second part
    assert len(run().loaded_files["transactions"]) == 1
    assert ids(store) == [1, 2, 3]
    assert run().loaded_files["transactions"] == [] and ids(store) == [1, 2, 3]
    assert len(files.list_files(spark, arch)) == 2 and os.listdir(landing) == []


def test_crash_before_the_ledger_loads_a_file_once(spark, tmp_path, monkeypatch):
    landing, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "wh"))
    feed(landing, "transactions_01032021.txt", row(1), row(2, "2021-03-02 00:00:00"), row(3, "not a time"))
    monkeypatch.setattr(daily, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        daily.load_transactions(spark, store, landing)
    monkeypatch.undo()
    assert daily.load_transactions(spark, store, landing).rejects == 1
    assert ids(store) == [1, 2, 3]


def test_folders_below_the_landing_folder(spark, tmp_path):
    base = f"{tmp_path}/"  # as "." does, the landing folder holds all the others
    feed(base + "sub/part", "transactions_01032021.txt", row(1))
    feed(base, "transactions_02032021.txt", row(2, "2021-03-02 10:00:00"))
    for _ in range(2):
        daily.run_day(spark, base, base + "warehouse", report_dt="2021-03-04", archive_dir=base + "archive",
                      export_dir=base)
    assert ids(TableStore(spark, base + "warehouse")) == [1, 2]
    found = sorted(os.path.relpath(os.path.join(d, f), base + "archive")
                   for d, _, fs in os.walk(base + "archive") for f in fs if not f.endswith(".crc"))
    assert found == ["sub/part/transactions_01032021.txt", "transactions_02032021.txt"]
    with pytest.raises(ValueError):
        daily.archive(spark, [], base + "archive/in", base + "archive")
    assert files.qualify(spark, ".").startswith("file:/") and not files.qualify(spark, ".").endswith(".")


def test_files_that_cannot_be_read_are_rejected_and_stay(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "wh")
    feed(landing, "transactions_99992021.txt", row(1))
    feed(landing, "transactions_01032021.txt", "5;1,00", header="transaction_id;amount\n")
    feed(landing, "transactions_02032021.txt", row(2))
    terminal = ("T1", "ATM", "Moscow", "A")
    for name, sheet, header, rows in (
            ("terminals_01032021.xlsx", "other", workbook.TERMINAL_COLUMNS, [terminal]),
            ("terminals_02032021.xlsx", "terminals", workbook.TERMINAL_COLUMNS[:3], [terminal[:3]]),
            ("terminals_99992021.xlsx", "terminals", workbook.TERMINAL_COLUMNS, [terminal]),
            ("terminals_03032021.xlsx", "terminals", workbook.TERMINAL_COLUMNS, [terminal, (None, "ATM", "x", "y")]),
            ("passport_blacklist_01032021.xlsx", "blacklist", ["passport", "date"], [("p1", 44256), (None, 44256)])):
        (tmp_path / "in" / name).write_bytes(staging.workbook_bytes(sheet, header, rows))
    (tmp_path / "in" / "terminals_04032021.xlsx").write_bytes(b"no zip")
    res = daily.run_day(spark, landing, root, report_dt="2021-03-04", archive_dir=str(tmp_path / "arch"))
    store = TableStore(spark, root)
    assert sorted(os.path.basename(p) for p in res.rejected_files) == sorted([
        "transactions_99992021.txt", "transactions_01032021.txt", "terminals_01032021.xlsx",
        "terminals_02032021.xlsx", "terminals_99992021.xlsx", "terminals_04032021.xlsx"])
    assert res.rejects == {"transactions": 0, "terminals": 1, "passport_blacklist": 1}
    assert ids(store) == [2] and store.read("terminals").count() == 1 and store.read("passport_blacklist").count() == 1
    assert store.read("_ingest_ledger").count() == 3
    assert sorted(f for f in os.listdir(landing) if not f.startswith(".")) == sorted(
        os.path.basename(p) for p in res.rejected_files)


def test_columns_are_taken_by_name(spark, tmp_path):
    feed(tmp_path, "transactions_01032021.txt", row(1))
    feed(tmp_path, "transactions_02032021.txt", "T1;c9;2;2021-03-02 10:00:00;5,00;x;PAYMENT;SUCCESS",
         header="terminal;card_num;transaction_id;transaction_date;amount;extra;oper_type;oper_result\n")
    got = {r["trans_id"]: r for r in feeds.normalise_transactions(feeds.read_tx_feed(spark, str(tmp_path))).collect()}
    assert got["2"]["card_num"] == "c9" and str(got["2"]["amt"]) == "5.00" and got["1"]["card_num"] == "c1"


def test_rerun_leaves_one_slice_and_one_export(spark, planted, tmp_path):
    store, out = TableStore(spark, str(tmp_path / "wh")), str(tmp_path / "out")
    full = report.build_report(planted, "2021-03-04", "2021-03-04 00:00:00")
    other = report.build_report(planted, "2021-03-05", "2021-03-04 00:00:00")
    report.write_report(store, other, "2021-03-05")
    n = full.count()
    for k, rep in enumerate((full, full.limit(3), full.limit(0), full)):
        report.write_report(store, rep, "2021-03-04")
        day = report.report_for_day(store, "2021-03-04")
        report.export_report(spark, day, out, "2021-03-04", str(tmp_path / f"staging{k}"))
        want = (n, 3, 0, n)[k]
        assert day.count() == want
        if want:
            assert report.read_export(spark, out).count() == want
        else:
            assert files.list_files(spark, out) == []
    assert report.report_for_day(store, "2021-03-05").count() == n


def test_since_prunes_day_partitions(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "wh")
    for d in range(1, 6):
        feed(landing, f"transactions_0{d}032021.txt", row(d, f"2021-03-0{d} 10:00:00"))
    wh = planted_warehouse(spark)
    daily.run_day(spark, landing, root, report_dt="2021-03-06",
                  seeds={"cards": wh.cards, "accounts": wh.accounts, "clients": wh.clients})
    rep = report.build_report(TableStore(spark, root).warehouse(), "2021-03-06", since="2021-03-05 00:00:00.7")
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trans_day" in plan
    rep.collect()


def test_corrected_slice_and_row_order(spark):
    def slices(*rows):
        schema = schemas.T.StructType([*SLICE_SCHEMA.fields, schemas.T.StructField("row_no", schemas.T.IntegerType())])
        return spark.createDataFrame([("T9", "ATM", "Omsk", a, TS("2021-03-01 00:00:00"), n) for a, n in rows], schema)

    first = history.load_history(None, slices(("first", 1), ("second", 2)), KEYS, ATTRS, row_col="row_no")
    assert [r["terminal_address"] for r in first.collect()] == ["second"]
    again = history.load_history(first, slices(("corrected", 1)), KEYS, ATTRS, row_col="row_no")
    assert [r["terminal_address"] for r in again.collect()] == ["corrected"]


def test_older_blacklist_file_lowers_the_start(spark, tmp_path):
    store, keys = TableStore(spark, str(tmp_path / "wh")), ["passport_num", "entry_dt"]
    for day in ("2021-03-03", "2021-03-01", "2021-03-02"):
        rows = spark.createDataFrame([("p3", D("2021-03-01"), TS(day + " 00:00:00"))], BL_SCHEMA)
        known = store.read("passport_blacklist") if store.exists("passport_blacklist") else None
        store.append("passport_blacklist", history.insert_if_absent(known, rows, keys))
    assert _bl_rows(store.read("passport_blacklist")) == [("p3", "2021-03-01", "2021-03-01 00:00:00")]


def test_point_in_time_covers_the_last_fraction_of_a_second(spark):
    slices = spark.createDataFrame(
        [("T1", "ATM", "A", a, TS(f"2021-03-0{d} 00:00:00")) for d, a in ((1, "x"), (2, "x"), (3, "y"))],
        SLICE_SCHEMA)
    hist = history.scd2_history(slices, KEYS, ATTRS)
    assert chain.merged_intervals(hist).count() == 2
    at = [dt.datetime(2021, 3, d, 23, 59, 59, 500_000) for d in (1, 2, 3)]
    tx = spark.createDataFrame([(str(i), t, "T1") for i, t in enumerate(at)],
                               schemas.T.StructType([f for f in schemas.TRANSACTIONS.fields
                                                     if f.name in ("trans_id", "trans_date", "terminal")]))
    got = {r["trans_id"]: r["terminal_address"] for r in chain.with_terminal_at_event(tx, hist).collect()}
    assert got == {"0": "x", "1": "x", "2": "y"}
    assert history.as_of(hist, at[1]).count() == 1


def test_one_scan_report_equals_its_rules(spark, planted):
    from fraudmart.operators import rules
    double = planted.terminals.unionByName(planted.terminals.filter("terminal_id = 'T1'").withColumns(
        {"terminal_type": F.lit("POS"), "terminal_city": F.lit("Perm")}))
    no_city = planted.terminals.withColumn("terminal_city", F.when(F.col("terminal_id") != "T2", F.col("terminal_city")))
    for wh in (planted, planted.with_(terminals=double), planted.with_(terminals=no_city)):
        for pit in (False, True):
            for emit in ("both", "later"):
                parts = [rules.fraud_passport(wh, "2021-03-04", "2021-03-04 00:00:00"), rules.fraud_contract(wh, "2021-03-04"),
                         rules.fraud_city_hop(wh, "2021-03-04", "2021-03-04 00:00:00", emit, point_in_time=pit),
                         rules.fraud_amount_guess(wh, "2021-03-04", "2021-03-04 00:00:00", point_in_time=pit)]
                want = parts[0]
                for p in parts[1:]:
                    want = want.unionByName(p)
                got = rules.all_rules(wh, "2021-03-04", "2021-03-04 00:00:00", emit, pit)
                assert sorted(got.collect()) == sorted(want.collect()), (pit, emit)


def test_report_reads_the_fact_once(spark, tmp_path):
    feed(tmp_path / "in", "transactions_01032021.txt", row(1))
    root = str(tmp_path / "wh")
    daily.run_day(spark, str(tmp_path / "in"), root, report_dt="2021-03-06")
    rep = report.build_report(TableStore(spark, root).warehouse(), "2021-03-06")
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trans_day") <= 2 and plan.count("Relation [trans_id") == 1


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from fraudmart.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
