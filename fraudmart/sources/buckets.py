"""Validity history kept by key bucket, so that a load costs what arrives.

Rows lie below ``gen=G/state=open|closed/bucket=B``. Each load is a generation. A
manifest version (one small Parquet folder per load, below ``_manifest``) names for every bucket the
generation whose open rows hold, and the generation from which on its closed rows
hold; a reader takes the newest committed manifest and prunes folders by it.

A load reads only the open rows of the buckets its keys fall into, closes those a new
slice follows, and writes those buckets' open rows and the newly closed ones. Closed
rows of earlier loads are never touched, unless a slice arrives that is not newer than
its key's open row: then that key's bucket, and no other, is recomputed from all its
rows. Loading slices in any order, or twice, gives the table ``scd2_history`` gives
of all slices together.

A load that dies leaves a generation no manifest names; the next load writes over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import ts_lit
from fraudmart.operators import history
from fraudmart.session import scratch_path
from fraudmart.sources import files

MANIFEST = "bucket int, open_gen long, closed_from long"


class BucketedHistory:
    """A validity-dated table below ``path``. ``buckets`` holds for a new table; a stored
    one keeps its own number."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], attrs: Sequence[str], schema: T.StructType,
                 buckets: int = 32):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.attrs, self._buckets = list(keys), list(attrs), buckets

    # -- manifest: one row per bucket

    def _versions(self) -> list[int]:
        names = files.list_dirs(self.spark, f"{self.path}/_manifest")
        return sorted(int(n.split("=")[1]) for n in names
                      if n.startswith("v=") and files.exists(self.spark, f"{self.path}/_manifest/{n}/_SUCCESS"))

    def exists(self) -> bool:
        return bool(self._versions())

    def manifest(self) -> list[tuple[int, int, int]]:
        versions = self._versions()
        if not versions:
            return [(b, 0, 1) for b in range(self._buckets)]
        found = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/_manifest/v={versions[-1]:09d}").collect()
        return sorted(tuple(r) for r in found)

    def generation(self) -> int:
        return max(self._versions(), default=0)

    def _commit(self, gen: int, manifest: list[tuple[int, int, int]]) -> None:
        (self.spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/_manifest/v={gen:09d}"))

    # -- reading

    def _stored(self) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField("gen", T.LongType()),
                              T.StructField("state", T.StringType()), T.StructField("bucket", T.IntegerType())])
        if not files.exists(self.spark, self.path):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(self.path)

    def _live(self, manifest: list[tuple[int, int, int]], open_rows: bool = True, closed_rows: bool = True) -> Column:
        """The folders that hold: static conditions on the partition columns."""
        last, out = self.generation(), F.lit(False)

        def grouped(at: int) -> dict[int, list[int]]:
            found: dict[int, list[int]] = {}
            for row in manifest:
                found.setdefault(row[at], []).append(row[0])
            return found

        if open_rows:
            for gen, own in grouped(1).items():
                out = out | ((F.col("state") == "open") & (F.col("gen") == gen) & F.col("bucket").isin(own))
        if closed_rows:
            for gen, own in grouped(2).items():
                out = out | ((F.col("state") == "closed") & F.col("gen").between(gen, last) & F.col("bucket").isin(own))
        return out

    def read(self) -> DataFrame:
        return self._stored().filter(self._live(self.manifest())).select(*self.schema.fieldNames())

    # -- loading

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, gen: int) -> None:
        state = F.when(F.col("effective_to") == ts_lit(schemas.OPEN_END), "open").otherwise("closed")
        (rows.select(*self.schema.fieldNames()).withColumns({"state": state, "bucket": self._bucket(len(self.manifest()))})
         .repartition("bucket", "state").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("state", "bucket").parquet(f"{self.path}/gen={gen}"))

    def load(self, slices: DataFrame, row_col: str | None = None, close_missing: bool = False) -> int:
        """Fold new slices (``keys``, ``attrs``, ``effective_from``) into the table; returns the
        generation written. With ``close_missing`` every key depends on all slices, so
        all buckets are recomputed."""
        manifest = self.manifest()
        gen = self.generation() + 1
        path = scratch_path(self.spark, "slices")
        slices.withColumn("bucket", self._bucket(len(manifest))).write.parquet(path)
        slices = self.spark.read.parquet(path)
        stored = self._stored()
        open_rows = stored.filter(self._live(manifest, closed_rows=False))

        # buckets are few and fixed in number: their list is all the driver sees
        newest = open_rows.select(*self.keys, F.col("effective_from").alias("_newest"))
        cond = F.lit(True)
        for k in self.keys:
            cond = cond & F.col(f"s.{k}").eqNullSafe(F.col(f"o.{k}"))
        marked = (slices.alias("s").join(newest.alias("o"), cond, "left").groupBy(F.col("s.bucket").alias("bucket"))
                  .agg(F.max(F.coalesce(F.col("s.effective_from") <= F.col("o._newest"), F.lit(False))).alias("late")).collect())
        touched = {r["bucket"]: bool(r["late"]) for r in marked}
        if close_missing and touched:
            touched = {b: True for b, _, _ in manifest}
        if not touched:
            return self.generation()
        late, clean = [b for b, x in touched.items() if x], [b for b, x in touched.items() if not x]

        existing = open_rows.filter(F.col("bucket").isin(clean)).unionByName(
            stored.filter(self._live([m for m in manifest if m[0] in late])))
        new = history.load_history(existing.select(*self.schema.fieldNames()), slices, self.keys, self.attrs, close_missing, row_col)
        self._write(new, gen)
        self._commit(gen, [(b, gen if b in touched else o, gen if touched.get(b) else c) for b, o, c in manifest])
        return gen

    def create(self) -> None:
        """Commit an empty first manifest, if there is none."""
        if not self.exists():
            self._commit(1, [(b, 1, 1) for b in range(self._buckets)])

    def compact(self) -> int:
        """Write all rows as one generation, so that folders do not grow with the loads."""
        manifest, gen = self.manifest(), self.generation() + 1
        self._write(self.read(), gen)
        self._commit(gen, [(b, gen, gen) for b, _, _ in manifest])
        return gen

    def written(self, gen: int) -> int:
        """Rows a generation wrote."""
        return self._stored().filter(F.col("gen") == gen).count()
