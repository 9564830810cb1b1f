"""Validity-dated (SCD2) history, point-in-time reads and idempotent loads.

Parquet tables have no MERGE/UPDATE, so history is not patched row by row:
it is recomputed from every slice with one window per key (slices are daily,
so a key contributes one row per day and no key can grow a hot partition)
and written to a new location. Loading slices in any order, or twice, gives
the same table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import ts_lit


def as_of(history: DataFrame, at: _dt.datetime | str | Column | None = None,
          include_deleted: bool = False) -> DataFrame:
    """Rows valid at ``at``, up to the end of the second ``effective_to``; ``None``
    means now.
    Soft-deleted rows (deleted_flg = 1) are left out unless asked for."""
    at_col = at if isinstance(at, Column) else ts_lit(at)
    cond = (at_col >= F.col("effective_from")) & (at_col < F.col("effective_to") + F.expr("INTERVAL 1 SECOND"))
    if not include_deleted:
        cond = cond & (F.col("deleted_flg") == 0)
    return history.filter(cond)


def scd2_history(slices: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                 from_col: str = "effective_from", row_col: str | None = None,
                 close_missing: bool = False) -> DataFrame:
    """Validity intervals from full slices.

    ``slices`` holds one row per key and slice, ``from_col`` being the slice's
    business time. A key's row is open until the key's next slice row starts
    (closed one second earlier), else until 9999-12-31 23:59:59. A new row
    starts at every slice, changed or not. When a key repeats inside a slice,
    the last row (largest ``row_col``) wins. With ``close_missing`` a row is
    also closed when the next slice does not carry its key.
    """
    keys, attrs = list(keys), list(attrs)
    if row_col is not None:
        picked = (slices.groupBy(*keys, from_col)
                  .agg(F.max_by(F.struct(*attrs), F.col(row_col)).alias("_v"))
                  .select(*keys, from_col, *[F.col(f"_v.{a}").alias(a) for a in attrs]))
    else:
        picked = slices.select(*keys, *attrs, from_col).dropDuplicates([*keys, from_col])
    w = Window.partitionBy(*keys).orderBy(from_col)
    next_start = F.lead(from_col, 1).over(w)
    end = next_start - F.expr("INTERVAL 1 SECOND")
    hist = picked.withColumn("effective_to", F.coalesce(end, ts_lit(schemas.OPEN_END)))
    if close_missing:
        # Slice calendar: one row per slice time, so its size is bounded by the
        # number of loads, not by the data.
        cal = picked.select(F.col(from_col).alias("_slice")).distinct()
        cal = cal.withColumn("_next_slice",
                             F.lead("_slice", 1).over(Window.orderBy("_slice")))
        hist = (hist.join(F.broadcast(cal), hist[from_col] == cal["_slice"], "left")
                .withColumn("effective_to", F.least(
                    F.col("effective_to"),
                    F.coalesce(F.col("_next_slice") - F.expr("INTERVAL 1 SECOND"),
                               ts_lit(schemas.OPEN_END))))
                .drop("_slice", "_next_slice"))
    return (hist.withColumnRenamed(from_col, "effective_from")
                .withColumn("deleted_flg", F.lit(0)))


def history_as_slices(history: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Project stored history back to the slice rows it came from: every
    history row started at exactly one slice."""
    return history.select(*keys, *attrs, "effective_from")


def load_history(existing: DataFrame | None, new_slices: DataFrame, keys: Sequence[str],
                 attrs: Sequence[str], close_missing: bool = False, row_col: str | None = None) -> DataFrame:
    """Fold new slices into stored history; order-free and idempotent. With
    ``row_col`` the largest of it wins when a key repeats in a slice, and rows
    loaded now win over stored rows of the same slice (a corrected slice)."""
    order = F.struct(F.lit(1).alias("load"), (F.col(row_col) if row_col else F.lit(None)).alias("row"))
    rows = new_slices.select(*keys, *attrs, "effective_from", order.alias("_order"))
    if existing is not None:
        first = F.struct(F.lit(0).alias("load"), F.lit(None).cast(rows.schema["_order"].dataType["row"].dataType).alias("row"))
        rows = history_as_slices(existing, keys, attrs).withColumn("_order", first).unionByName(rows)
    return scd2_history(rows, keys, attrs, row_col="_order", close_missing=close_missing)


def insert_if_absent(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                     from_col: str = "effective_from") -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, or is stored from a
    later time than an older file gives: each key once with its earliest
    ``from_col``; open-ended, not deleted. Readers take the earliest row of a key,
    so files may arrive in any order. Null keys never match and are dropped
    (``insert_if_absent_rejects`` counts them)."""
    keys = list(keys)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    first = incoming.filter(not_null).groupBy(*keys).agg(F.min(from_col).alias("effective_from"))
    if existing is not None:
        known = existing.groupBy(*keys).agg(F.min("effective_from").alias("_known_from"))
        first = (first.join(known, keys, "left")
                 .filter(F.col("_known_from").isNull() | (F.col("effective_from") < F.col("_known_from")))
                 .drop("_known_from"))
    return (first.withColumn("effective_to", ts_lit(schemas.OPEN_END))
                 .withColumn("deleted_flg", F.lit(0)))


def insert_if_absent_rejects(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows with a null key, which ``insert_if_absent`` drops."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return incoming.filter(cond)


def open_rows_per_id(history: DataFrame, id_col: str, at=None) -> DataFrame:
    """Data-quality view: ids with more than one current row (a terminal that
    changed type keeps its old row open)."""
    return (as_of(history, at).groupBy(id_col).agg(F.count(F.lit(1)).alias("open_rows"))
            .filter(F.col("open_rows") > 1))
