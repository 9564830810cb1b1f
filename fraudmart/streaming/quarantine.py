"""Rows a stream cannot use, kept; and the repair of the days they touch.

One query computes the report events and watches every arriving row. Each
micro-batch is written once, below ``batch=N``: its events (``kind=event``) and the
rows that could not take part (``kind=row``) with a reason:

* ``no time``: the time did not parse; the row can meet no rule;
* ``late``: at or behind the watermark of its batch, that is ``delay`` before the
  newest time of the batches before it; rules 3 and 4 did not see it in order;
* ``no amount``: the amount did not parse; it takes part, but ends any chain of rule 4.

A batch that runs again after a crash replaces its own folder, and its watermark
follows from the marks of the batches before it, so the outcome is the same. The
stateful rules may use a row that is listed as late (their own watermark follows
only rows of their types); the repair makes both cases equal.

``repaired_report`` replaces the events of every day a late row can have touched by
those of the batch rules over the fact, which holds late rows like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudmart import schemas
from fraudmart.functions import ts_lit
from fraudmart.operators import rules
from fraudmart.operators.report import LOOKBACK_SECONDS
from fraudmart.sources import files
from fraudmart.streaming import stateful
from fraudmart.streaming.ingest import with_event_time
from fraudmart.warehouse import Warehouse

EVENT_COLUMNS = [*schemas.REPORT_COLUMNS, "established_dt"]
ROW_COLUMNS = schemas.TRANSACTIONS.fieldNames()
_REPORT_TYPES = {f.name: f.dataType for f in schemas.REPORT.fields} | {"established_dt": schemas.TS}
EVENTS = T.StructType([T.StructField(c, _REPORT_TYPES[c]) for c in EVENT_COLUMNS])
ROWS = T.StructType([*schemas.TRANSACTIONS.fields, T.StructField("reason", T.StringType())])
MARK = "newest timestamp"


def report_events(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None, delay: str = "1 hour") -> DataFrame:
    """The four rules' events on a stream, with the time that established each."""
    live = wh.with_(transactions=tx_stream)
    parts = [rules.fraud_passport(live, report_dt, as_of), rules.fraud_contract(live, report_dt),
             stateful.stream_sequence_rules(wh, tx_stream, report_dt, as_of, delay=delay)]
    out = parts[0].select(*EVENT_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*EVENT_COLUMNS))
    return out


def _watched(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of, delay: str) -> DataFrame:
    events = report_events(wh, tx_stream, report_dt, as_of, delay).withColumn("kind", F.lit("event"))
    rows = with_event_time(tx_stream).select(*ROW_COLUMNS, F.col("event_time").alias("arrived_time"),
                                             F.lit("row").alias("kind"))
    return events.unionByName(rows, allowMissingColumns=True)


def _watermark(spark: SparkSession, marks: str, batch_id: int, delay: str):
    """``delay`` before the newest time of the earlier batches; one row is kept per batch."""
    if not files.exists(spark, marks):
        return None
    found = spark.read.schema(f"{MARK}, batch long").parquet(marks).filter(F.col("batch") < batch_id)
    return found.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("wm")).first()["wm"]


def _write_batch(path: str, marks: str, delay: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wm = _watermark(spark, marks, batch_id, delay)
        time = F.col("arrived_time")
        late = time <= F.lit(wm) if wm is not None else F.lit(False)
        reason = (F.when(F.col("kind") == "event", F.lit(None).cast("string")).when(time.isNull(), "no time")
                  .when(late, "late").when(F.col("amt").isNull(), "no amount"))
        seen = Observation()
        (batch.observe(seen, F.max("arrived_time").alias("newest")).withColumn("reason", reason)
         .filter((F.col("kind") == "event") | F.col("reason").isNotNull()).drop("arrived_time")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind").parquet(f"{path}/batch={batch_id}"))
        newest = spark.createDataFrame([(seen.get["newest"],)], MARK)
        newest.write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")
    return write


def start_watched_report(wh: Warehouse, tx_stream: DataFrame, path: str, checkpoint: str, report_dt, as_of=None,
                         delay: str = "1 hour", available_now: bool = True) -> StreamingQuery:
    """Start the report stream that keeps what it cannot use below ``path``."""
    w = (_watched(wh, tx_stream, report_dt, as_of, delay).writeStream
         .foreachBatch(_write_batch(f"{path}/batches", f"{path}/marks", delay))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _stored(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("kind", T.StringType())])
    if not files.exists(spark, f"{path}/batches"):
        return spark.createDataFrame([], whole).drop("kind")
    return spark.read.schema(whole).parquet(f"{path}/batches").filter(F.col("kind") == kind).drop("kind")


def streamed_events(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, "event", EVENTS).drop("batch")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rows kept aside, with ``reason`` and ``batch``."""
    return _stored(spark, path, "row", ROWS)


def touched_days(late: DataFrame) -> DataFrame:
    """``day``: the days in which an event may be established otherwise once these
    rows are in their place (a pair, and the pair after it)."""
    end = F.to_date(F.col("trans_date") + F.expr(f"INTERVAL {LOOKBACK_SECONDS} SECONDS"))
    return late.select(F.explode(F.sequence(F.to_date("trans_date"), end)).alias("day")).distinct()


def repaired_report(wh: Warehouse, path: str, report_dt, as_of=None) -> DataFrame:
    """Report rows: streamed events, those of touched days taken from the fact.
    ``wh.transactions`` is the whole fact; only the rows from the first touched day
    on, less the look-back, are read."""
    spark = wh.transactions.sparkSession
    events = streamed_events(spark, path)
    days = touched_days(quarantined(spark, path).filter("reason = 'late'"))
    first = days.agg(F.min("day").alias("day")).first()["day"]
    if first is None:
        return rules.report_rows(events)
    start = ts_lit(f"{first} 00:00:00") - F.expr(f"INTERVAL {LOOKBACK_SECONDS} SECONDS")
    tx = wh.transactions.filter(F.col("trans_date") >= start)
    if "trans_day" in tx.columns:
        tx = tx.filter(F.col("trans_day") >= F.to_date(start))
    fresh = rules.all_rules(wh.with_(transactions=tx), report_dt, as_of).select(*EVENT_COLUMNS)
    on_day = F.to_date("established_dt") == F.col("day")
    kept = events.join(days, on_day, "left_anti")
    again = fresh.join(days, on_day, "left_semi")
    return rules.report_rows(kept.unionByName(again))
