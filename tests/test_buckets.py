"""Bucketed history: any order of loads gives the whole recomputation, and a load
writes what arrives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.operators import history
from fraudmart.sources.buckets import BucketedHistory
from planted_cases import TS

KEYS, ATTRS = ["terminal_id", "terminal_type"], ["terminal_city", "terminal_address"]
SLICE = "terminal_id string, terminal_type string, terminal_city string, terminal_address string, effective_from timestamp_ntz"


def day_slice(spark, day, rows):
    return spark.createDataFrame([(*r, TS(f"2021-03-{day:02d}")) for r in rows], SLICE)


def table(spark, path, buckets=4):
    return BucketedHistory(spark, str(path), KEYS, ATTRS, schemas.TERMINALS, buckets)


def sample(seed, day):
    rnd = random.Random(seed * 100 + day)
    return [(f"t{i}", rnd.choice(["ATM", "POS"]) if i % 9 == 0 else "ATM", f"city{rnd.randint(0, 2)}", f"a{day % 2}")
            for i in range(40) if rnd.random() < 0.8]


def rows(df):
    return sorted(tuple(r) for r in df.select(*schemas.TERMINALS.fieldNames()).collect())


@pytest.mark.parametrize("seed", range(3))
def test_any_order_equals_the_whole(spark, tmp_path, seed):
    days = {d: day_slice(spark, d, sample(seed, d)) for d in (1, 2, 3, 4)}
    whole = None
    for s in days.values():
        whole = s if whole is None else whole.unionByName(s)
    want = rows(history.scd2_history(whole, KEYS, ATTRS))
    order = list(days)
    random.Random(seed).shuffle(order)
    t = table(spark, tmp_path / "t")
    for d in [*order, order[0]]:  # one of them twice
        t.load(days[d])
    assert rows(t.read()) == want
    t.compact()
    assert rows(t.read()) == want and t.written(t.generation()) == len(want)


def test_a_load_writes_what_arrives(spark, tmp_path):
    t = table(spark, tmp_path / "t", buckets=8)
    every = [(f"t{i}", "ATM", "x", "y") for i in range(200)]
    written = []
    for d in range(1, 7):
        written.append(t.written(t.load(day_slice(spark, d, every))))
    assert written == [200] + [400] * 5  # the new open rows and the rows they close, not the history
    few = t.written(t.load(day_slice(spark, 8, every[:1])))
    assert few <= 200 / 8 * 2 + 2  # one bucket's open rows
    late = t.load(day_slice(spark, 7, every[1:2]))
    assert t.written(late) <= 7 * 200 / 8 * 2 + 2  # one bucket's history
    assert t.read().filter("terminal_id = 't1'").count() == 7


def test_a_load_that_died_is_written_over(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    t.create()
    assert t.read().count() == 0 and t.exists()
    t.load(day_slice(spark, 1, [("a", "ATM", "x", "y")]))
    before = rows(t.read())
    broken = table(spark, tmp_path / "t")
    broken._commit = lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost"))
    with pytest.raises(RuntimeError):
        broken.load(day_slice(spark, 2, [("a", "ATM", "z", "y"), ("b", "ATM", "z", "y")]))
    assert rows(t.read()) == before
    t.load(day_slice(spark, 3, [("a", "ATM", "q", "y")]))
    assert sorted(r[2] for r in rows(t.read())) == ["q", "x"]


def test_repeats_corrections_and_missing_keys(spark, tmp_path):
    one = day_slice(spark, 1, [("a", "ATM", "x", "1"), ("b", "ATM", "x", "1")]).withColumn("_row", F.monotonically_increasing_id())
    two = day_slice(spark, 2, [("a", "ATM", "x", "2"), ("a", "ATM", "x", "3")]).withColumn(
        "_row", F.col("terminal_address").cast("int"))
    for close in (False, True):
        t = table(spark, tmp_path / f"t{close}")
        for s in (one, two):
            t.load(s, "_row", close)
        fixed = day_slice(spark, 2, [("a", "ATM", "x", "4")]).withColumn("_row", F.lit(0))
        t.load(fixed, "_row", close)
        got = rows(t.read())
        assert [(r[0], r[3]) for r in got] == [("a", "1"), ("a", "4"), ("b", "1")]
        assert (got[2][5] == TS(schemas.OPEN_END)) != close
        assert t.load(one.limit(0), "_row", close) == t.generation()


def test_workbooks_streamed_into_the_tables(spark, tmp_path):
    from fraudmart.plans import staging
    from fraudmart.sources import workbook
    from fraudmart.sources.store import TableStore
    from fraudmart.streaming.ingest import ingest_blacklist, ingest_terminals
    landing, store = tmp_path / "in", TableStore(spark, str(tmp_path / "wh"))
    landing.mkdir()

    def arrive(name, sheet, columns, rows):
        (landing / name).write_bytes(staging.workbook_bytes(sheet, columns, rows))

    def run():
        ingest_terminals(spark, str(landing), store, str(tmp_path / "ck1")).awaitTermination()
        ingest_blacklist(spark, str(landing), store, str(tmp_path / "ck2")).awaitTermination()

    arrive("terminals_02032021.xlsx", "terminals", workbook.TERMINAL_COLUMNS, [("a", "ATM", "x", "2"), ("a", "ATM", "x", "3")])
    arrive("passport_blacklist_02032021.xlsx", "blacklist", workbook.BLACKLIST_COLUMNS, [("p", "2021-03-01"), (None, "2021-03-01")])
    (landing / "terminals_03032021.xlsx").write_bytes(b"no workbook")
    run()
    arrive("terminals_01032021.xlsx", "terminals", workbook.TERMINAL_COLUMNS, [("a", "ATM", "x", "1"), (None, "ATM", "q", "q")])
    arrive("terminals_04032021.xlsx", "other", workbook.TERMINAL_COLUMNS, [("a", "ATM", "x", "4")])
    arrive("passport_blacklist_01032021.xlsx", "blacklist", workbook.BLACKLIST_COLUMNS, [("p", "2021-03-01"), ("q", "2021-03-01")])
    run()
    run()  # nothing new
    assert [(r[3], str(r[4])[:10], str(r[5])[:10]) for r in rows(store.read("terminals"))] == [
        ("1", "2021-03-01", "2021-03-01"), ("3", "2021-03-02", "9999-12-31")]
    assert sorted((r["passport_num"], str(r["effective_from"])[:10]) for r in store.read("passport_blacklist").collect()) == [
        ("p", "2021-03-01"), ("q", "2021-03-01")]
    bad = {r["file_path"].rsplit("/", 1)[-1]: r["reason"] for r in store.read("_rejects").collect()}
    assert bad == {"terminals_03032021.xlsx": "not a workbook: BadZipFile",
                   "terminals_04032021.xlsx": "no rows in a sheet named terminals"}
