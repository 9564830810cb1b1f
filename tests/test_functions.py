"""Scalar column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fraudmart.functions import abs_gap_seconds, date_lit, date_tag, full_name, ts_lit


def test_literals_do_not_depend_on_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = spark.range(1).select(ts_lit("2021-03-01 00:00:00").alias("a"),
                                      ts_lit(dt.datetime(2021, 3, 1, 12, 30, 1, 5)).alias("b"),
                                      date_lit("2021-03-04").alias("c")).first()
            assert r["a"] == dt.datetime(2021, 3, 1) and r["b"] == dt.datetime(2021, 3, 1, 12, 30, 1, 5)
            assert r["c"] == dt.date(2021, 3, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_full_name_propagates_nulls(spark):
    df = spark.createDataFrame([("A", "B", "C"), ("A", None, "C")], "l string, f string, p string")
    assert [r["n"] for r in df.select(full_name("l", "f", "p").alias("n")).collect()] == ["A B C", None]


def test_gap_counts_whole_seconds_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 3, 3, 10, 0, 0, 900000), dt.datetime(2021, 3, 3, 11, 0, 0)),
                                (dt.datetime(2021, 3, 3, 11, 0, 0), dt.datetime(2021, 3, 3, 12, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    gaps = [r["g"] for r in df.select(abs_gap_seconds("a", "b").alias("g")).collect()]
    assert gaps == [3600, 3601]


def test_date_tag(spark):
    r = spark.range(1).select(date_tag(F.lit("2021-03-04").cast("date")).alias("t")).first()
    assert r["t"] == "04032021"
