"""The accumulating report mart: build, write, read a day, export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import date_lit, date_tag, iso_date, ts_lit
from fraudmart.operators import rules
from fraudmart.sources import feeds, files
from fraudmart.sources.store import TableStore
from fraudmart.warehouse import Warehouse

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


LOOKBACK_SECONDS = max(2 * schemas.CITY_HOP_SECONDS, schemas.AMOUNT_GUESS_SECONDS)


def build_report(wh: Warehouse, report_dt=None, as_of=None, since=None,
                 city_hop_emit: str = "both", point_in_time: bool = False,
                 distinct_events: bool = False) -> DataFrame:
    """All four rules over the whole history, stamped with ``report_dt``
    (as the original, old events reappear under every new report date).

    ``since`` keeps the events *established* at or after that instant: the
    first operation of a city-hop pair counts when the second one happens, so
    daily runs with ``since`` at midnight add up to the full report, pairs across
    midnight included. Only the operations that can decide them are read: from
    the whole second of ``since`` minus twice the hop window (a pair, and the pair
    before it); on the stored table that prunes day partitions."""
    if since is not None:
        start = F.date_trunc("second", ts_lit(since)).cast(schemas.TS) - F.expr(f"INTERVAL {LOOKBACK_SECONDS} SECONDS")
        tx = wh.transactions.filter(F.col("trans_date") >= start)
        if "trans_day" in tx.columns:
            tx = tx.filter(F.col("trans_day") >= F.to_date(start))
        wh = wh.with_(transactions=tx)
    out = rules.all_rules(wh, report_dt, as_of, city_hop_emit, point_in_time, distinct_events)
    if since is not None:
        out = out.filter(F.col("established_dt") >= ts_lit(since))
    return rules.report_rows(out)


def write_report(store: TableStore, report: DataFrame, report_dt) -> None:
    """Replace the slice of ``report_dt``, also by an empty report."""
    day = report.filter(F.col("report_dt") == date_lit(report_dt)).select(*schemas.REPORT_COLUMNS)
    store.replace_partition("reporting_list", day, iso_date(report_dt))


def report_for_day(store: TableStore, report_dt) -> DataFrame:
    """The mart's slice for one report date (partition pruned)."""
    return store.read("reporting_list").filter(F.col("report_dt") == date_lit(report_dt))


def export_report(spark: SparkSession, day: DataFrame, out_dir: str, report_dt,
                  staging: str) -> list[str]:
    """Write the day's slice as ``report_DDMMYYYY.csv`` part files below
    ``out_dir/report_dt=YYYY-MM-DD``, which is replaced as a whole; a day
    without rows leaves no file."""
    target = f"{out_dir.rstrip('/')}/report_dt={iso_date(report_dt)}"
    if day.isEmpty():
        files.delete(spark, target)
        return []
    tag = date_tag(date_lit(report_dt))
    (day.orderBy("event_dt").withColumn("_feed_day", tag)
     .write.mode("overwrite").partitionBy("_feed_day").option("header", "true")
     .option("timestampNTZFormat", TS_FORMAT).csv(staging))
    files.delete(spark, target)
    return feeds.publish(spark, staging, target, "report", "csv")


def read_export(spark: SparkSession, out_dir: str) -> DataFrame:
    fields = schemas.REPORT
    return (spark.read.schema(fields).option("header", "true")
            .option("timestampNTZFormat", TS_FORMAT)
            .option("pathGlobFilter", "report_????????.csv")
            .option("recursiveFileLookup", "true").csv(out_dir))

