"""As-of join by sorted merge: each row meets the validity row that began last.

Rows and validity starts are unioned and range partitioned by (key, time), so a key
with very many rows or very many changes splits anywhere. Inside a partition the
last start is carried forward. A key that goes on from one partition into the next
brings the last start of the partitions before: at most one key crosses each
boundary, so these are fewer than twice the partitions and travel by broadcast.

A row is read once and never multiplied by the number of changes of its key, as it
is where an equi-join on the key compares it with every interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.session import scratch_path


def asof_join(rows: DataFrame, starts: DataFrame, keys: Sequence[str], time: str, start: str,
              values: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``rows`` with ``values`` of the row of ``starts`` that has the same keys and the
    latest ``start`` not after ``time``; nulls where there is none. Keys must have the
    same names on both sides, ``values`` must not be columns of ``rows``, and a key has one
    row per ``start``. Rows with a null key or time meet nothing."""
    spark, keys, values = rows.sparkSession, list(keys), list(values)
    usable = F.col(time).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    own = [c for c in rows.columns if c not in keys]
    left = rows.filter(usable).select(
        *keys, F.col(time).alias("_at"), F.lit(1).alias("_kind"), F.struct(*own).alias("_row"))
    right = starts.filter(F.col(start).isNotNull()).select(
        *keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.struct(*values).alias("_value"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = [*keys, "_at", "_kind"]
    path = scratch_path(spark, "asof")  # written once: a task that is run again sees the same ranges
    (left.unionByName(right, allowMissingColumns=True).repartitionByRange(n, *line)
     .withColumn("_part", F.spark_partition_id()).write.parquet(path))
    merged = spark.read.parquet(path)

    spread = merged.groupBy(*keys, "_part").agg(
        F.max_by("_value", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_last"))
    by_part = Window.partitionBy(*keys).orderBy("_part")
    before = F.last("_last", ignorenulls=True).over(by_part.rowsBetween(Window.unboundedPreceding, -1))
    carried = (spread.withColumn("_before", before).filter(F.col("_before").isNotNull())
               .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_of"), "_before"))
    same = F.col("_part") == F.col("_of")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_part").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (merged.withColumn("_found", F.last("_value", ignorenulls=True).over(inside)).filter("_kind = 1")
             .join(F.broadcast(carried), same, "left")
             .withColumn("_found", F.coalesce("_found", "_before")))
    out = found.select(*keys, "_row.*", "_found.*")
    none = rows.filter(~F.coalesce(usable, F.lit(False))).select(*keys, *own)
    return out.unionByName(none, allowMissingColumns=True).select(*rows.columns, *values)
