"""The transaction fact as a table bucketed by card.

The ownership chain joins the fact on the card. While the owners fit a broadcast,
Spark joins without a shuffle; once they outgrow it, every report would shuffle the
whole history. A fact stored in buckets of the join key is already dealt out: only the
owners, one row per card, move to its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEY = "card_num"


def append_bucketed(transactions: DataFrame, table: str, path: str, buckets: int = 200) -> None:
    """Append rows to the bucketed table (made at ``path`` if it is not there). Rows go to
    their buckets first, so a load writes at most one file per bucket."""
    (transactions.repartition(buckets, KEY).write.mode("append").format("parquet").option("path", path)
     .bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table))


def bucketed_fact(spark: SparkSession, table: str) -> DataFrame:
    """The table, read by bucket wherever a join or an aggregate on the card can use it."""
    return spark.table(table)
