"""Bucketed neighbour operators equal plain windows / brute force."""

from __future__ import annotations

import random
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.operators.sequence import ordered_neighbours, recent_other_value

from planted_cases import SF001


def _random_rows(n=400, keys=4, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # A hot key (0) holds about half the rows; some equal timestamps.
        k = 0 if rnd.random() < 0.5 else rnd.randrange(1, keys)
        t = base + dt.timedelta(seconds=rnd.randrange(0, 3 * 86400) // 30 * 30)
        rows.append((f"k{k}", t, f"{i:05d}", rnd.choice(["A", "B", "C"]), rnd.randrange(100)))
    return rows


SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("id", T.StringType()), T.StructField("city", T.StringType()),
                       T.StructField("v", T.IntegerType())])


def test_ordered_neighbours_matches_plain_window(spark):
    df = spark.createDataFrame(_random_rows(), SCHEMA)
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("id", *[F.lag("v", j).over(w).alias(f"prev{j}_v") for j in (1, 2, 3)],
                      *[F.lead("city", j).over(w).alias(f"next{j}_city") for j in (1, 2)])
    # one range, few, and more ranges than rows of a key: keys cut anywhere
    for n in (1, 2, 7, 150):
        got = ordered_neighbours(df, ["k"], "ts", "id", ["v", "city"], lags=3, leads=2, partitions=n)
        got = got.select("id", "prev1_v", "prev2_v", "prev3_v", "next1_city", "next2_city")
        assert sorted(got.collect()) == sorted(plain.collect()), n


def test_ordered_neighbours_with_many_hot_keys_bursts_and_nulls(spark):
    rnd, base, rows = random.Random(3), dt.datetime(2024, 1, 1), []
    for k in ["a", "b", "c", "d", None]:
        for i in range(120):
            # a burst of equal times, one stray early row
            t = base + dt.timedelta(seconds=0 if i else -10**7) if i % 3 else base
            rows.append((k, t, f"{k}{i:04d}", rnd.choice("AB"), i))
    df = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = df.select("id", F.lag("v", 2).over(w).alias("p"), F.lead("v", 1).over(w).alias("n"))
    for n in (3, 40):
        ranged = ordered_neighbours(df, ["k"], "ts", "id", ["v"], lags=2, leads=1, partitions=n)
        got = ranged.select("id", F.col("prev2_v").alias("p"), F.col("next1_v").alias("n"))
        assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str), n


def test_ordered_neighbours_on_shared_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        F.col("user_id").alias("k"), "ts", F.col("event_id").alias("id"), "event_type")
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = ev.select("id", F.lag("event_type", 1).over(w).alias("p"), F.lead("ts", 1).over(w).alias("n"))
    got = ordered_neighbours(ev, ["k"], "ts", "id", ["event_type", "ts"], lags=1, leads=1)
    got = got.select("id", F.col("prev1_event_type").alias("p"), F.col("next1_ts").alias("n"))
    assert sorted(got.collect()) == sorted(plain.collect())


def test_recent_other_value_matches_brute_force(spark):
    rows = _random_rows(300, keys=3, seed=11)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("sec", F.unix_timestamp("ts"))
    for lookback in (600, 3600):
        expected = set()
        for k, t, i, city, _ in rows:
            for k2, t2, _, city2, _ in rows:
                gap = (t - t2).total_seconds()
                if k2 == k and city2 != city and 0 <= gap <= lookback:
                    expected.add(i)
                    break
        for bucket in (1, 1800, 5000, 86400):
            got = recent_other_value(df, ["k"], "sec", "city", lookback, bucket)
            assert sorted(r["id"] for r in got.collect()) == sorted(expected), (lookback, bucket)


def test_recent_other_value_ignores_nulls(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("k", base + dt.timedelta(minutes=10 * i), str(i), c, i) for i, c in enumerate(["A", None, "B", "B", None])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("sec", F.unix_timestamp("ts"))
    assert sorted(r["id"] for r in recent_other_value(df, ["k"], "sec", "city", 3600).collect()) == ["2", "3"]
    assert [r["id"] for r in recent_other_value(df, ["k"], "sec", "city", 1200).collect()] == ["2"]


def test_hot_key_is_spread_even_when_input_is_partitioned_by_key(spark):
    df = spark.createDataFrame(_random_rows(), SCHEMA).repartition(4, "k")
    got = ordered_neighbours(df, ["k"], "ts", "id", ["v"], lags=1, partitions=12)
    rows = got.filter("k = 'k0'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(rows) > 1
