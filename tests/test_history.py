"""SCD2 history, as-of reads and insert-if-absent (FIXTURES.md §4)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.operators import history

from planted_cases import TS, D

KEYS = ["terminal_id", "terminal_type"]
ATTRS = ["terminal_city", "terminal_address"]
CITY = {"T1": "Moscow", "T2": "Kazan", "T3": "Moscow"}
SLICES = {
    "2021-03-01": [("T1", "ATM", "A"), ("T2", "POS", "X")],
    "2021-03-02": [("T1", "ATM", "B"), ("T3", "ATM", "Y")],
    "2021-03-03": [("T1", "POS", "B"), ("T2", "POS", "X"), ("T3", "ATM", "Y")],
}
SLICE_SCHEMA = T.StructType([
    T.StructField("terminal_id", T.StringType()), T.StructField("terminal_type", T.StringType()),
    T.StructField("terminal_city", T.StringType()), T.StructField("terminal_address", T.StringType()),
    T.StructField("effective_from", schemas.TS)])

EXPECTED = sorted([
    ("T1", "ATM", "A", "2021-03-01 00:00:00", "2021-03-01 23:59:59"),
    ("T1", "ATM", "B", "2021-03-02 00:00:00", schemas.OPEN_END),
    ("T1", "POS", "B", "2021-03-03 00:00:00", schemas.OPEN_END),
    ("T2", "POS", "X", "2021-03-01 00:00:00", "2021-03-02 23:59:59"),
    ("T2", "POS", "X", "2021-03-03 00:00:00", schemas.OPEN_END),
    ("T3", "ATM", "Y", "2021-03-02 00:00:00", "2021-03-02 23:59:59"),
    ("T3", "ATM", "Y", "2021-03-03 00:00:00", schemas.OPEN_END),
])


def _slice(spark, day):
    return spark.createDataFrame(
        [(i, t, CITY[i], a, TS(day + " 00:00:00")) for i, t, a in SLICES[day]], SLICE_SCHEMA)


def _rows(hist):
    return sorted((r["terminal_id"], r["terminal_type"], r["terminal_address"],
                   str(r["effective_from"]), str(r["effective_to"]))
                  for r in hist.collect())


def test_scd2_from_all_slices(spark):
    slices = None
    for day in SLICES:
        s = _slice(spark, day)
        slices = s if slices is None else slices.unionByName(s)
    hist = history.scd2_history(slices, KEYS, ATTRS)
    assert _rows(hist) == EXPECTED
    assert set(r["deleted_flg"] for r in hist.collect()) == {0}


def test_load_order_and_repeats_do_not_matter(spark):
    for order in itertools.permutations(SLICES):
        stored = None
        for day in list(order) + [order[0]]:  # one file loaded twice
            stored = history.load_history(stored, _slice(spark, day), KEYS, ATTRS)
        assert _rows(stored) == EXPECTED


def test_as_of(spark):
    slices = _slice(spark, "2021-03-01").unionByName(_slice(spark, "2021-03-02")).unionByName(
        _slice(spark, "2021-03-03"))
    hist = history.scd2_history(slices, KEYS, ATTRS)

    def at(ts):
        return sorted((r["terminal_id"], r["terminal_type"])
                      for r in history.as_of(hist, ts).collect())
    assert at("2021-03-02 12:00:00") == [("T1", "ATM"), ("T2", "POS"), ("T3", "ATM")]
    assert at("2021-03-03 12:00:00") == [("T1", "ATM"), ("T1", "POS"), ("T2", "POS"), ("T3", "ATM")]
    assert at("2021-03-01 23:59:59") == [("T1", "ATM"), ("T2", "POS")]
    dq = history.open_rows_per_id(hist, "terminal_id", "2021-03-03 12:00:00").collect()
    assert [(r["terminal_id"], r["open_rows"]) for r in dq] == [("T1", 2)]


def test_intervals_never_overlap(spark):
    slices = _slice(spark, "2021-03-01").unionByName(_slice(spark, "2021-03-02")).unionByName(
        _slice(spark, "2021-03-03"))
    h = history.scd2_history(slices, KEYS, ATTRS).alias("a")
    o = h.alias("b")
    clash = h.join(o, (F.col("a.terminal_id") == F.col("b.terminal_id"))
                   & (F.col("a.terminal_type") == F.col("b.terminal_type"))
                   & (F.col("a.effective_from") < F.col("b.effective_from"))
                   & (F.col("b.effective_from") <= F.col("a.effective_to")))
    assert clash.count() == 0


def test_close_missing(spark):
    slices = _slice(spark, "2021-03-01").unionByName(_slice(spark, "2021-03-02"))
    hist = history.scd2_history(slices, KEYS, ATTRS, close_missing=True)
    t2 = [r for r in hist.collect() if r["terminal_id"] == "T2"]
    assert [str(r["effective_to"]) for r in t2] == ["2021-03-01 23:59:59"]


def test_repeated_key_in_one_slice_keeps_last(spark):
    rows = [("T9", "ATM", "Omsk", "first", TS("2021-03-01 00:00:00"), 1),
            ("T9", "ATM", "Omsk", "second", TS("2021-03-01 00:00:00"), 2)]
    schema = T.StructType(list(SLICE_SCHEMA.fields) + [T.StructField("row_no", T.IntegerType())])
    hist = history.scd2_history(spark.createDataFrame(rows, schema), KEYS, ATTRS, row_col="row_no")
    assert [r["terminal_address"] for r in hist.collect()] == ["second"]


BL_SCHEMA = T.StructType([T.StructField("passport_num", T.StringType()),
                          T.StructField("entry_dt", T.DateType()),
                          T.StructField("effective_from", schemas.TS)])
BL_FILES = {
    "2021-03-01": [("p3", "2021-03-01")],
    "2021-03-02": [("p3", "2021-03-01"), ("p5", "2021-03-02")],
    "2021-03-03": [("p3", "2021-03-01"), ("p5", "2021-03-02"), ("p3", "2021-03-03"), (None, "2021-03-03")],
}
BL_EXPECTED = sorted([("p3", "2021-03-01", "2021-03-01 00:00:00"),
                      ("p5", "2021-03-02", "2021-03-02 00:00:00"),
                      ("p3", "2021-03-03", "2021-03-03 00:00:00")])


def _bl(spark, day):
    return spark.createDataFrame([(p, D(d), TS(day + " 00:00:00")) for p, d in BL_FILES[day]], BL_SCHEMA)


def _bl_rows(df):
    return sorted((r["passport_num"], str(r["entry_dt"]), str(r["effective_from"])) for r in df.collect())


def test_blacklist_insert_if_absent_file_by_file(spark):
    stored = None
    for day in BL_FILES:
        new = history.insert_if_absent(stored, _bl(spark, day), ["passport_num", "entry_dt"])
        stored = new if stored is None else stored.unionByName(new)
    assert _bl_rows(stored) == BL_EXPECTED
    # All files at once gives the same; the null passport is rejected, not inserted.
    everything = _bl(spark, "2021-03-01").unionByName(_bl(spark, "2021-03-02")).unionByName(
        _bl(spark, "2021-03-03"))
    once = history.insert_if_absent(None, everything, ["passport_num", "entry_dt"])
    assert _bl_rows(once) == BL_EXPECTED
    assert history.insert_if_absent_rejects(everything, ["passport_num", "entry_dt"]).count() == 1


def _row_at_a_time(slices_by_day):
    """The original loader, one row at a time: for each row of a slice close
    the open row of the same (id, type) at slice time - 1 s, then insert a new
    open row. Slices are loaded in date order."""
    import datetime as dt
    table = []
    for day in sorted(slices_by_day):
        start = TS(day + " 00:00:00")
        for tid, ttype, addr in slices_by_day[day]:
            for r in table:
                if r[0] == tid and r[1] == ttype and r[4] == TS(schemas.OPEN_END):
                    r[4] = start - dt.timedelta(seconds=1)
            table.append([tid, ttype, addr, start, TS(schemas.OPEN_END)])
    return sorted((a, b, c, str(d), str(e)) for a, b, c, d, e in table)


def test_scd2_equals_row_at_a_time_loader(spark):
    import random
    rnd = random.Random(5)
    for trial in range(6):
        days = sorted(rnd.sample([f"2021-03-{d:02d}" for d in range(1, 11)], rnd.randint(1, 5)))
        slices = {}
        for day in days:
            rows = {}
            for _ in range(rnd.randint(1, 6)):
                tid, ttype = f"T{rnd.randint(1, 4)}", rnd.choice(["ATM", "POS"])
                rows[(tid, ttype)] = rnd.choice("ABC")  # one row per key and slice
            slices[day] = [(k[0], k[1], a) for k, a in rows.items()]
        expected = _row_at_a_time(slices)
        df = spark.createDataFrame(
            [(i, t, "City", a, TS(day + " 00:00:00")) for day, rs in slices.items() for i, t, a in rs],
            SLICE_SCHEMA)
        got = _rows(history.scd2_history(df, KEYS, ATTRS))
        assert got == expected, trial
