"""Rule 3 in its any-pair form as a stream-stream interval join, without Python.

The stream of successful operations is joined to itself on the client, with the
event times at most the look-back apart and the cities different, as a semi join:
an operation is reported once, with the first other operation that proves it. Both
sides carry a watermark and the condition bounds their distance, so Spark keeps an
operation only until the watermark has passed what it could still meet.

The join key also holds a time bucket: the searching side stands in its own bucket
and the other side also in each bucket its look-back reaches, so that a client with
very many operations spreads over its time span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart import schemas
from fraudmart.functions import date_lit
from fraudmart.operators import chain
from fraudmart.operators.sequence import DEFAULT_BUCKET_SECONDS
from fraudmart.streaming.ingest import watermarked
from fraudmart.warehouse import Warehouse


def _successes(wh: Warehouse, tx_stream: DataFrame, as_of, delay: str) -> DataFrame:
    tx = watermarked(tx_stream, delay).filter(F.col("oper_result") == schemas.RESULT_SUCCESS)
    rows = chain.with_terminal(chain.ownership_chain(wh, tx), chain.current_terminals(wh, as_of))
    return rows.filter(F.col("terminal_city").isNotNull())


def _bucket(sec: Column, width: int) -> Column:
    return F.floor(sec / F.lit(width))


def stream_city_hop_interval_join(wh: Warehouse, tx_stream: DataFrame, report_dt, as_of=None,
                                  seconds: int = schemas.CITY_HOP_SECONDS, emit: str = "later",
                                  delay: str = "1 hour", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Report rows of operations that follow (``emit="later"``), or follow or precede
    (``"both"``), a successful operation of the same client in another city at most
    ``seconds`` away. Equals ``rules.city_hop_any_pair`` for rows within the delay. A
    row is released as soon as its pair is complete; nothing waits for the watermark."""
    if emit not in ("later", "both"):
        raise ValueError("emit must be 'later' or 'both'")
    width = max(int(bucket_seconds), int(seconds))
    ahead = int(seconds) if emit == "both" else 0
    at = F.unix_timestamp("trans_date")
    rows = _successes(wh, tx_stream, as_of, delay).withColumn("bucket", _bucket(at, width))
    # an operation can be met from `ahead` seconds before it to `seconds` after it
    other = _successes(wh, tx_stream, as_of, delay).select(
        F.col("client_id").alias("o_client"), F.col("terminal_city").alias("o_city"), F.col("event_time").alias("o_time"),
        F.explode(F.sequence(_bucket(at - ahead, width), _bucket(at + int(seconds), width))).alias("o_bucket"))
    near = (F.col("o_time") >= F.col("event_time") - F.expr(f"INTERVAL {int(seconds)} SECONDS")) \
        & (F.col("o_time") <= F.col("event_time") + F.expr(f"INTERVAL {ahead} SECONDS"))
    met = rows.join(other, (F.col("client_id") == F.col("o_client")) & (F.col("bucket") == F.col("o_bucket"))
                    & (F.col("terminal_city") != F.col("o_city")) & near, "left_semi")
    return met.select("trans_id", "client_id", F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"),
                      "fio", "phone", F.lit(schemas.EVENT_CITY_HOP).alias("event_type"),
                      date_lit(report_dt).alias("report_dt"))
