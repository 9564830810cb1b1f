"""The report mart fed by a stream: the four rules on arriving transactions,
unioned into one streaming query and appended to a Parquet file sink
partitioned by ``report_dt`` (the sink's commit log makes every micro-batch
land exactly once)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fraudmart import schemas
from fraudmart.streaming import rules as srules
from fraudmart.streaming import stateful
from fraudmart.warehouse import Warehouse


def stream_report(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                  delay: str = "1 hour") -> DataFrame:
    parts = [
        srules.stream_passport(wh, tx_stream, report_dt, as_of),
        srules.stream_contract(wh, tx_stream, report_dt),
        # rules 3 and 4 share one keyed state (one stateful Python operator per query)
        stateful.stream_sequence_rules(wh, tx_stream, report_dt, as_of, delay=delay)
        .select(*schemas.REPORT_COLUMNS),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def start_report_stream(wh: Warehouse, tx_stream: DataFrame, mart_path: str, checkpoint: str,
                        report_dt, as_of=None, delay: str = "1 hour",
                        available_now: bool = True) -> StreamingQuery:
    w = (stream_report(wh, tx_stream, report_dt, as_of, delay).writeStream.format("parquet")
         .option("path", mart_path).option("checkpointLocation", checkpoint)
         .partitionBy("report_dt").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
