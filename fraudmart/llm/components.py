"""Connected components by alternating large-star and small-star.

Every step is a map-side combined ``min`` per node and a join back, so a node
with very many links is neither collected into one group nor a single task
(adaptive execution splits its join). Each iteration is written to the shared
folder, which ends the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of integer node ids to ``(node, component)``: the
    component is the smallest node reachable. Only nodes with a link to
    another node appear. Nulls, loops and repeated links are ignored."""
    e = stored(edges.filter("a is not null and b is not null and a <> b")
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "links")
    state = _state(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        e = stored(_small_star(_large_star(e)), "links")
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
