"""Rules on arriving transactions and a runner that drains a stream.

Rules 1 and 2 need no order: each arriving transaction is joined to the
static owner dimension (and blacklist), a stream-static join, and filtered.
Rules 3 and 4 keep per-key state (``fraudmart.streaming.stateful``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudmart import schemas
from fraudmart.operators import rules
from fraudmart.session import rocksdb_state
from fraudmart.warehouse import Warehouse


def stream_passport(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None) -> DataFrame:
    return rules.report_rows(rules.fraud_passport(wh.with_(transactions=tx_stream), report_dt, as_of))


def stream_contract(wh: Warehouse, tx_stream: DataFrame, report_dt) -> DataFrame:
    return rules.report_rows(rules.fraud_contract(wh.with_(transactions=tx_stream), report_dt))


def transaction_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of transaction rows stored as Parquet files."""
    r = spark.readStream.schema(schemas.TRANSACTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(folder)


def drain_to_table(spark: SparkSession, df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a streaming DataFrame until its sources are drained
    (``availableNow``), appending to a Parquet sink; return the table."""
    with rocksdb_state(spark):
        q = (df.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(df.schema).parquet(path)
