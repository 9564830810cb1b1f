"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is put in a shuffled order (an md5 of its id and
the pass number, so reruns agree). Its virtual finish time is the source's
cumulative size up to it, divided by the source's target. All documents are
range-sorted by finish time and cut where the running total passes the budget.
Up to ``max_passes`` passes over a source can be taken.

Targets share the budget by weight; no target exceeds ``max_passes`` times its
source's size, and what is left over is shared again among the others.

Running sums never gather a source: sizes are summed per (source, pass, bucket
of the shuffle key), buckets get an offset, and the running sum inside a bucket
is added. The global cut needs one total per range partition and the order
inside the single partition where the budget ends.

Null source: a source of its own, ordered last. Null size counts 0. Null ids
are documents like any other. Rows equal in id, source and size are copies of
one document, numbered from 1; each has its own place. A null or missing weight
counts 0: nothing is taken of that source. Empty input gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import stored

BIG = "decimal(38,0)"
BUCKET_BITS = 12
KEY_BITS = 60


def source_key(source: Column) -> Column:
    """Sources as comparable keys; null is distinct from every name."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def cyclic_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights for the sources in code point order, null last (one row per
    source)."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    names = sizes.select("source").distinct().withColumn("at", F.row_number().over(order) - 1)
    values = F.array(*[F.lit(w) for w in cycle])
    return names.select("source", F.element_at(values, (F.col("at") % len(cycle) + 1).cast("int")).alias("weight"))


@dataclass
class Mix:
    """``documents``: one row per document with its taken amount.
    ``sequence``: the taken documents in mix order (doc_id, source, size, copy,
    pass, finish), range-partitioned and sorted."""

    documents: DataFrame
    sequence: DataFrame


def targets(sources: DataFrame, budget: int, max_passes: int) -> DataFrame:
    """``sources(skey, source_size, weight)`` plus ``target``."""
    cap = F.col("source_size").cast(BIG) * max_passes
    weight = F.col("weight").cast(BIG)
    left, share = budget, None  # what is still to be shared, by the weights of the others
    full = F.lit(False) | (F.col("weight") <= 0)
    while True:
        r = sources.agg(F.sum(F.when(full & (weight > 0), cap).otherwise(0)).alias("c"),
                        F.sum(F.when(full, 0).otherwise(weight)).alias("w"),
                        F.sum(F.when(full, 1).otherwise(0)).alias("n")).first()
        left, total = budget - int(r["c"] or 0), int(r["w"] or 0)
        if share == (left, total) or total == 0:
            break
        share = (left, total)
        over = cap * F.lit(total).cast(BIG) < weight * F.lit(left).cast(BIG)
        full = (F.col("weight") <= 0) | over
    open_target = (weight * F.lit(left).cast(BIG)).cast("double") / F.lit(float(max(total, 1)))
    return sources.withColumn("target", F.when(F.col("weight") <= 0, 0.0)
                              .when(full, cap.cast("double")).otherwise(open_target))


def mix(sizes: DataFrame, weights: DataFrame, *, budget: int | None = None, max_passes: int = 3) -> Mix:
    """Mix ``sizes(doc_id, source, size)`` to whole-number ``weights(source,
    weight)``. ``budget``: total size to take (default: the size of all)."""
    spark = sizes.sparkSession
    rows = stored(
        sizes.select("doc_id", "source", F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
        .select("doc_id", "source", source_key(F.col("source")).alias("skey"), "size",
                F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")), "mix-sizes")
    by_weight = weights.select(source_key(F.col("source")).alias("skey"), "weight")
    sources = stored(rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
                     .join(by_weight, "skey", "left")
                     .withColumn("weight", F.coalesce(F.col("weight").cast("long"), F.lit(0))), "mix-sources")
    if budget is None:
        budget = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    aimed = targets(sources, budget, max_passes)

    # cumulative size in shuffled order, per source and pass
    key = F.conv(F.substring(F.md5(F.concat_ws(":", "pass", "doc_id", "size", "copy").cast("binary")), 1, 15),
                 16, 10).cast("long")
    offers = (rows.withColumn("pass", F.explode(F.array(*[F.lit(i) for i in range(max_passes)])))
              .withColumn("key", key)
              .withColumn("bucket", F.shiftright("key", KEY_BITS - BUCKET_BITS)))
    group = ["skey", "pass", "bucket"]
    before = (offers.groupBy(*group).agg(F.sum("size").alias("in_bucket"))
              .withColumn("ahead", F.sum("in_bucket").over(
                  Window.partitionBy("skey", "pass").orderBy("bucket")) - F.col("in_bucket"))
              .select(*group, "ahead"))
    order = ["key", "doc_id", "size", "copy"]
    inside = F.sum("size").over(Window.partitionBy(*group).orderBy(*order)
                                .rowsBetween(Window.unboundedPreceding, 0))
    timed = (offers.withColumn("inside", inside).join(before, group)
             .join(aimed.select("skey", "source_size", "target"), "skey")
             .filter("target > 0")
             .withColumn("finish", (F.col("pass") * F.col("source_size") + F.col("ahead") + F.col("inside"))
                         .cast("double") / F.col("target")))

    # global order and cut
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = ["finish", "skey", "pass", *order]
    ranged = stored(timed.select("doc_id", "source", "size", "copy", "skey", "pass", "key", "finish")
                    .repartitionByRange(parts, *line).sortWithinPartitions(*line)
                    .withColumn("part", F.spark_partition_id()), "mix-order")
    ends = (ranged.groupBy("part").agg(F.sum("size").alias("n"))
            .withColumn("ahead", F.sum("n").over(Window.orderBy("part")) - F.col("n")))
    cut = ends.filter(F.col("ahead") + F.col("n") > budget).agg(F.min(F.struct("part", "ahead")).alias("at")).first()["at"]
    if cut is None:
        taken = ranged
    else:
        run = F.sum("size").over(Window.orderBy(*line).rowsBetween(Window.unboundedPreceding, 0))
        taken = (ranged.filter(F.col("part") < cut["part"])
                 .unionByName(ranged.filter(F.col("part") == cut["part"]).withColumn("run", run)
                              .filter(F.col("run") + cut["ahead"] <= budget).drop("run")))
    sequence = taken.select("doc_id", "source", "size", "copy", "pass", "finish")

    one = ["doc_id", "skey", "size", "copy"]
    found = taken.groupBy(*one).agg(F.count("*").alias("times"))
    same = F.lit(True)
    for c in one:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    documents = (rows.alias("a").join(found.alias("b"), same, "left")
                 .select("a.doc_id", "a.source", "a.skey", "a.size", "a.copy",
                         F.coalesce("b.times", F.lit(0)).alias("times"))
                 .join(aimed.select("skey", "source_size", "target"), "skey")
                 .select("doc_id", "source", "size", "copy", "source_size", "target", "times",
                         (F.col("size") * F.col("times")).alias("taken")))
    return Mix(documents, sequence)
