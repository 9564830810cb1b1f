"""Incremental ingestion of transaction feed files (Structured Streaming).

The file source remembers which files it has read (checkpoint), the Parquet
file sink commits each micro-batch atomically through its metadata log, so a
file is loaded exactly once even when the job is killed and restarted.
``trigger(availableNow=True)`` turns it into a daily batch run that stops
when the folder is drained; ``cleanSource=archive`` moves files away once
they are committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fraudmart import schemas
from fraudmart.operators import history
from fraudmart.session import scratch_path
from fraudmart.sources import feeds, workbook
from fraudmart.sources.store import TableStore


def tx_feed_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                   archive_dir: str | None = None) -> DataFrame:
    """Streaming scan of transaction feed files, normalised to the table."""
    r = (spark.readStream.schema(schemas.TX_FEED)
         .option("sep", ";").option("header", "true")
         .option("enforceSchema", "false")  # columns in another order fail, they are not mixed up
         .option("pathGlobFilter", schemas.TX_FEED_GLOB)
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    raw = r.csv(landing)
    return feeds.normalise_transactions(feeds._with_file(raw))


def with_event_time(df: DataFrame, ts: str = "trans_date", out: str = "event_time") -> DataFrame:
    """Event-time column for watermarks: the wall-clock time as an instant
    (whole seconds), independent of the session zone."""
    return df.withColumn(out, F.timestamp_seconds(F.unix_timestamp(F.col(ts))))


def watermarked(tx_stream: DataFrame, delay: str) -> DataFrame:
    """Event time and watermark on the raw stream, before any join, so the
    watermark follows every arriving row. A row without a time has no place in any
    order and would never leave the state: it is not used here (the quarantine
    keeps it)."""
    return with_event_time(tx_stream.filter(F.col("trans_date").isNotNull())).withWatermark("event_time", delay)


def ingest_transactions(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                        archive_dir: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Load new feed files into a Parquet table partitioned by ``load_dt``."""
    stream = tx_feed_stream(spark, landing, max_files_per_trigger, archive_dir)
    w = (stream.writeStream.format("parquet").option("path", table_path)
         .option("checkpointLocation", checkpoint).partitionBy("load_dt").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _workbook_stream(spark: SparkSession, landing: str, glob: str) -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(landing)
            .select(F.col("path").alias("file_path"), "content"))


def _load_workbooks(spark: SparkSession, landing: str, glob: str, sheet: str, columns: list[str], store: TableStore,
                    checkpoint: str, load, available_now: bool) -> StreamingQuery:
    """Each micro-batch of new workbooks is parsed once and loaded; ``load`` gives the
    same table when a batch runs again. Workbooks that cannot be read are rows of
    ``_rejects``."""
    def batch(files: DataFrame, batch_id: int) -> None:
        path = scratch_path(files.sparkSession, "workbooks")
        workbook.checked_workbooks(files, sheet, columns).write.parquet(path)
        parsed = files.sparkSession.read.parquet(path)
        bad = parsed.filter("problem is not null").select(
            "file_path", F.lit(None).cast("string").alias("line"), F.col("problem").alias("reason"),
            F.substring(F.sha2("file_path", 256), 1, 20).alias("file_id"))
        store.overwrite_partitions("_rejects", bad)
        load(parsed.filter("problem is null"))

    w = (_workbook_stream(spark, landing, glob).writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_terminals(spark: SparkSession, landing: str, store: TableStore, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Stream terminal workbooks into the bucketed history, in whatever order they come."""
    def load(parsed: DataFrame) -> None:
        slices = workbook.terminal_slices(parsed).withColumn("_row", F.struct("file_name", "row_no"))
        store.history("terminals").load(slices.filter("terminal_id <> ''"), "_row")

    return _load_workbooks(spark, landing, schemas.TERMINAL_FEED_GLOB, schemas.TERMINAL_SHEET, workbook.TERMINAL_COLUMNS,
                           store, checkpoint, load, available_now)


def ingest_blacklist(spark: SparkSession, landing: str, store: TableStore, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Stream blacklist workbooks; a key is inserted once, from its earliest file."""
    def load(parsed: DataFrame) -> None:
        existing = store.read("passport_blacklist") if store.exists("passport_blacklist") else None
        new = history.insert_if_absent(existing, workbook.blacklist_rows(parsed), ["passport_num", "entry_dt"])
        staged = scratch_path(spark, "blacklist")  # the join reads the table that is appended to
        new.write.parquet(staged)
        store.append("passport_blacklist", spark.read.parquet(staged))

    return _load_workbooks(spark, landing, schemas.BLACKLIST_FEED_GLOB, schemas.BLACKLIST_SHEET, workbook.BLACKLIST_COLUMNS,
                           store, checkpoint, load, available_now)
