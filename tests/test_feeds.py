"""Feed scans: text feed, workbook reader, business dates, amounts."""

from __future__ import annotations

import datetime as dt
import decimal
import os

from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import amount_from_text, business_date, epoch_ms_to_date, excel_serial_to_date
from fraudmart.plans import staging
from fraudmart.sources import feeds, workbook

from planted_cases import PLANTED_FEED


def write_tx_files(folder, by_day=True):
    lines = PLANTED_FEED.strip().splitlines()
    header, rows = lines[0], lines[1:]
    days = {}
    for r in rows:
        d = r.split(";")[1][:10]
        days.setdefault(d, []).append(r)
    os.makedirs(folder, exist_ok=True)
    for d, rs in days.items():
        y, m, dd = d.split("-")
        with open(os.path.join(folder, f"transactions_{dd}{m}{y}.txt"), "w") as f:
            f.write("\n".join([header] + rs) + "\n")
    return days


def test_business_date(spark):
    df = spark.createDataFrame([("transactions_01032021.txt",), ("terminals_31122021.xlsx",),
                                ("passport_blacklist_05032021.xlsx",), ("readme.txt",),
                                ("transactions_99992021.txt",)], "n string")
    got = [r["d"] for r in df.select(business_date("n").alias("d")).collect()]
    assert got == [dt.datetime(2021, 3, 1), dt.datetime(2021, 12, 31), dt.datetime(2021, 3, 5),
                   None, None]


def test_amounts_and_dates(spark):
    df = spark.createDataFrame([("1234,56",), (" 10,5 ",), ("1 234,5",), ("abc",)], "a string")
    got = [r["x"] for r in df.select(amount_from_text("a").alias("x")).collect()]
    assert got == [decimal.Decimal("1234.56"), decimal.Decimal("10.50"), None, None]
    ms = spark.createDataFrame([(1614556800000,), (1614643199999,)], "ms long")
    assert [r["d"] for r in ms.select(epoch_ms_to_date("ms").alias("d")).collect()] == [
        dt.date(2021, 3, 1), dt.date(2021, 3, 1)]
    serial = spark.createDataFrame([(44256,)], "s int")
    assert serial.select(excel_serial_to_date("s").alias("d")).first()["d"] == dt.date(2021, 3, 1)


def test_text_feed_scan(spark, tmp_path):
    days = write_tx_files(str(tmp_path / "landing"))
    (tmp_path / "landing" / "notes.txt").write_text("ignored")
    feed = feeds.read_tx_feed(spark, str(tmp_path / "landing"))
    tx = feeds.normalise_transactions(feed)
    assert tx.count() == sum(len(v) for v in days.values())
    row = tx.filter(F.col("trans_id") == "34").first()
    assert row["amt"] == decimal.Decimal("100.00")
    assert row["trans_date"] == dt.datetime(2021, 3, 3, 10, 20)
    assert row["load_dt"] == dt.date(2021, 3, 3)
    assert feeds.transaction_rejects(feed).count() == 0
    listing = feeds.discover(spark, str(tmp_path / "landing"), schemas.TX_FEED_GLOB)
    assert listing.count() == len(days)


def test_tx_feed_round_trip(spark, planted, tmp_path):
    landing = str(tmp_path / "landing")
    feeds.write_tx_feed(spark, planted.transactions, str(tmp_path / "staging"), landing)
    back = feeds.normalise_transactions(feeds.read_tx_feed(spark, landing)).select(
        *[f.name for f in schemas.TRANSACTIONS.fields])
    assert sorted(back.collect()) == sorted(planted.transactions.collect())


def test_workbook_round_trip(spark, tmp_path):
    rows = [("T1", "ATM", "Moscow", "ул. Ленина, 1 & <2>"), ("T2", "POS", "Kazan", None)]
    blob = staging.workbook_bytes("terminals", workbook.TERMINAL_COLUMNS, rows)
    (tmp_path / "terminals_01032021.xlsx").write_bytes(blob)
    (tmp_path / "other.xlsx").write_bytes(blob)
    bl = staging.workbook_bytes("blacklist", ["passport", "date"], [("p3", 44256), ("p5", "2021-03-02")])
    (tmp_path / "passport_blacklist_02032021.xlsx").write_bytes(bl)
    parsed = workbook.read_workbooks(spark, str(tmp_path), schemas.TERMINAL_FEED_GLOB,
                                     "terminals", workbook.TERMINAL_COLUMNS)
    sl = workbook.terminal_slices(parsed).orderBy("terminal_id").collect()
    assert [(r["terminal_id"], r["terminal_address"]) for r in sl] == [
        ("T1", "ул. Ленина, 1 & <2>"), ("T2", None)]
    assert sl[0]["effective_from"] == dt.datetime(2021, 3, 1)
    b = workbook.blacklist_rows(workbook.read_workbooks(
        spark, str(tmp_path), schemas.BLACKLIST_FEED_GLOB, "blacklist", ["passport", "date"]))
    assert sorted((r["passport_num"], r["entry_dt"]) for r in b.collect()) == [
        ("p3", dt.date(2021, 3, 1)), ("p5", dt.date(2021, 3, 2))]
    # Missing sheet: no rows.
    none = workbook.read_workbooks(spark, str(tmp_path), schemas.TERMINAL_FEED_GLOB, "nope", ["a"])
    assert none.count() == 0


def test_workbook_shared_strings_and_date_cells(spark, tmp_path):
    # The layout spreadsheet tools write: shared strings, a styled date cell,
    # cells without references, a sheet that is not the first one.
    import io
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel_ns = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
    wb = (f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
          '<sheets><sheet name="other" sheetId="1" r:id="rId1"/>'
          '<sheet name="blacklist" sheetId="2" r:id="rId2"/></sheets></workbook>')
    rels = (f'<Relationships {rel_ns}>'
            '<Relationship Id="rId1" Type="x" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Type="x" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
    sst = f'<sst {ns}><si><t>passport</t></si><si><t>date</t></si><si><r><t>p</t></r><r><t>7</t></r></si></sst>'
    sheet2 = (f'<worksheet {ns}><sheetData>'
              '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
              '<row r="2"><c t="s"><v>2</v></c><c s="1"><v>44257</v></c></row>'
              '</sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData/></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", sheet2)
    (tmp_path / "passport_blacklist_02032021.xlsx").write_bytes(buf.getvalue())
    b = workbook.blacklist_rows(workbook.read_workbooks(
        spark, str(tmp_path), schemas.BLACKLIST_FEED_GLOB, "blacklist", ["passport", "date"])).collect()
    assert [(r["passport_num"], r["entry_dt"], r["effective_from"]) for r in b] == [
        ("p7", dt.date(2021, 3, 2), dt.datetime(2021, 3, 2))]


def test_lines_that_do_not_fit_are_kept_with_their_reason(spark, tmp_path):
    from fraudmart.plans import daily
    from fraudmart.sources.store import TableStore
    head = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"
    good = "1;2021-03-01 10:00:00;1,00;c1;PAYMENT;SUCCESS;T1"
    bad = {"2;2021-03-01 10:00:00;1,00": "fields", "3;2021-03-01 10:00:00;1,00;c1;PAYMENT;SUCCESS;T1;more": "fields",
           "4;soon;1,00;c1;PAYMENT;SUCCESS;T1": "time", "5;2021-03-01 10:00:00;1 2,x;c1;PAYMENT;SUCCESS;T1": "amount",
           "6;;;c1;PAYMENT;SUCCESS;T1": "time, amount"}
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "transactions_01032021.txt").write_text("\n".join([head, good, *bad]) + "\n")
    (landing / "transactions_02032021.txt").write_text(f"{head}\n7{good[1:]}\n")
    store = TableStore(spark, str(tmp_path / "wh"))
    loaded = daily.load_transactions(spark, store, str(landing))
    assert loaded.rejects == 5
    kept = store.read("_rejects").collect()
    assert {r["line"]: r["reason"] for r in kept} == bad
    assert {r["file_path"].rsplit("/", 1)[-1] for r in kept} == {"transactions_01032021.txt"}
    tx = {r["trans_id"]: r for r in store.read("transactions").collect()}
    assert sorted(tx) == ["1", "4", "5", "6", "7"]  # what has its fields is stored, with nulls
    assert tx["4"]["trans_date"] is None and tx["5"]["amt"] is None
    assert daily.load_transactions(spark, store, str(landing)).rejects == 0  # nothing new
    assert store.read("transactions").select("card_num").filter("card_num = 'c1'").count() == 5
