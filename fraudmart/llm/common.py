"""Shared helpers of the document operators: table reads, written
intermediate tables and the session settings Python stages need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.session import scratch_path, ship_package

#: A word is a run of anything but ASCII white space.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows per Arrow batch: texts can be long, so the row count is kept low.
ARROW_ROWS = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_stage(spark: SparkSession) -> None:
    """Make this package importable on executors and keep Arrow batches of
    texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor costs only a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """The words of a text, in order; no words for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def crc_bucket(doc_id: Column, buckets: int = 3) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def spread(name: str, *columns: str) -> Column:
    """A deterministic number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(F.lit(name), *columns), F.lit(1 << 40)) / float(1 << 40)
