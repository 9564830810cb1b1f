"""Neighbours in time that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one
task. Nothing here does, and nothing depends on a row count, a threshold or a
list of hot keys.

``ordered_neighbours``: exact lag/lead, unbounded in time. Rows are range
partitioned by (key, ts, tie), so any key splits anywhere, a burst of one
second included. Windows run per (key, range partition). Only a key that
straddles a partition boundary needs repair, and there are fewer such keys than
partitions: a proven bound for the broadcast. Their first and last k rows per
partition go through a second small window.

``context_buckets``: for look-backs bounded in time. Every row goes to the time
bucket of its own and, when it lies at most the look-back before the next
bucket's start, also to that bucket as context. A window per (key, bucket) then
sees all it needs in one shuffle; results are taken from the native rows.

``recent_other_value``: first reduced to the smallest and largest value per key
and second, so no window holds more than one row per second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.session import scratch_path

DEFAULT_BUCKET_SECONDS = 43_200  # context buckets: twelve hours and their look-back


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def ordered_neighbours(df: DataFrame, keys: Sequence[str], ts: str, tie: str,
                       values: Sequence[str], lags: int = 1, leads: int = 0,
                       partitions: int | None = None) -> DataFrame:
    """Add ``prev{j}_{v}`` (j = 1..lags) and ``next{j}_{v}`` (j = 1..leads)
    for each value column ``v``: the value of the j-th previous / next row of
    the same key in (ts, tie) order, null when there is none. ``partitions``:
    number of ranges (default: the session's shuffle partitions).

    The ranged rows are written once, so the input is read once and a rerun of
    a lost task sees the same ranges."""
    m = max(lags, leads)
    if m < 1:
        return df
    spark, keys = df.sparkSession, list(keys)
    part, rn, cnt, cut = "_sq_part", "_sq_rn", "_sq_cnt", "_sq_cut"
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranged")
    (df.repartitionByRange(n, *_cols(keys), F.col(ts), F.col(tie))
     .withColumn(part, F.spark_partition_id()).write.parquet(path))
    d = spark.read.parquet(path)
    # at most one key crosses each of the n - 1 boundaries
    same = [F.col(f"_cut_{k}") for k in keys]
    cuts = (d.groupBy(*_cols(keys)).agg(F.min(part).alias("_lo"), F.max(part).alias("_hi"))
            .filter("_lo < _hi").select(*[F.col(k).alias(f"_cut_{k}") for k in keys], F.lit(True).alias(cut)))
    on = F.lit(True)
    for k, c in zip(keys, same):
        on = on & F.col(k).eqNullSafe(c)
    d = d.join(F.broadcast(cuts), on, "left").drop(*[f"_cut_{k}" for k in keys])
    order = [F.col(ts), F.col(tie)]
    group = [*_cols(keys), F.col(part)]
    w_in = Window.partitionBy(*group).orderBy(*order)
    in_cols: dict[str, Column] = {rn: F.row_number().over(w_in),
                                  cnt: F.count(F.lit(1)).over(Window.partitionBy(*group))}
    for v in values:
        for j in range(1, lags + 1):
            in_cols[f"prev{j}_{v}"] = F.lag(v, j).over(w_in)
        for j in range(1, leads + 1):
            in_cols[f"next{j}_{v}"] = F.lead(v, j).over(w_in)
    d = d.withColumns(in_cols)

    edge = F.coalesce(F.col(cut), F.lit(False)) & ((F.col(rn) <= m) | (F.col(cnt) - F.col(rn) < m))
    # The first and last m rows per partition of a cut key are contiguous
    # wherever m steps can reach, so a window over them sees true neighbours.
    w_edge = Window.partitionBy(*_cols(keys)).orderBy(*order)
    fixes: dict[str, Column] = {}
    for v in values:
        for j in range(1, lags + 1):
            fixes[f"prev{j}_{v}"] = F.when(F.col(rn) > j, F.col(f"prev{j}_{v}")) \
                .otherwise(F.lag(v, j).over(w_edge))
        for j in range(1, leads + 1):
            fixes[f"next{j}_{v}"] = F.when(F.col(cnt) - F.col(rn) >= j, F.col(f"next{j}_{v}")) \
                .otherwise(F.lead(v, j).over(w_edge))
    return (d.filter(~edge).unionByName(d.filter(edge).withColumns(fixes))
            .drop(part, rn, cnt, cut))


def context_buckets(df: DataFrame, sec: str, lookback_seconds: int,
                    bucket_seconds: int = DEFAULT_BUCKET_SECONDS, lookahead_seconds: int = 0) -> DataFrame:
    """Add ``_cb_bucket`` and ``_cb_native``: every row once in its own bucket
    of the epoch-seconds column ``sec`` (native) and, when it lies at most
    ``lookback_seconds`` before the next bucket's start, once more in that
    bucket as context; with ``lookahead_seconds`` likewise in the bucket before."""
    width = max(int(bucket_seconds), int(lookback_seconds), int(lookahead_seconds))  # one context bucket is enough
    own = F.floor(F.col(sec) / F.lit(width))
    carry = F.col(sec) >= (own + 1) * width - int(lookback_seconds)
    buckets = F.when(carry, F.array(own, own + 1)).otherwise(F.array(own))
    if lookahead_seconds:
        back = F.col(sec) < own * width + int(lookahead_seconds)
        buckets = F.when(back, F.concat(F.array(own - 1), buckets)).otherwise(buckets)
    return (df.withColumn("_cb_own", own)
            .withColumn("_cb_bucket", F.explode(buckets))
            .withColumn("_cb_native", F.col("_cb_bucket") == F.col("_cb_own")).drop("_cb_own"))


def recent_other_value(df: DataFrame, keys: Sequence[str], sec: str, value: str, lookback_seconds: int,
                       bucket_seconds: int = DEFAULT_BUCKET_SECONDS, lookahead_seconds: int = 0) -> DataFrame:
    """Keep rows that have another row of the same key with a different
    ``value`` at most ``lookback_seconds`` earlier (or at the same second), or at
    most ``lookahead_seconds`` later.
    Null values differ from nothing and are neither reported nor compared."""
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull())
    seconds = rows.groupBy(*_cols(keys), sec).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    w = (Window.partitionBy(*_cols(keys), "_cb_bucket").orderBy(sec)
         .rangeBetween(-int(lookback_seconds), int(lookahead_seconds)))
    near = (context_buckets(seconds, sec, lookback_seconds, bucket_seconds, lookahead_seconds)
            .withColumns({"_lo": F.min("_lo").over(w), "_hi": F.max("_hi").over(w)})
            .filter(F.col("_cb_native") & (F.col("_lo") != F.col("_hi")))
            .select(*keys, sec, "_lo", "_hi"))
    return (rows.join(near, [*keys, sec])
            .filter((F.col("_lo") != F.col(value)) | (F.col("_hi") != F.col(value))).drop("_lo", "_hi"))
