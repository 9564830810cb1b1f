"""Exact length histogram of documents in tokens, and what it answers.

One pass encodes every whole text and keeps one number per document; documents
are aggregated by length. Suffix sums over the histogram then answer, for any
context limit, how many documents are longer, how many tokens there are in all
and how many are left when texts are cut at the limit; and quantiles of length.

The histogram has one row per distinct length (at most about sqrt(2 x all
tokens)). Sums run in two levels, inside blocks of lengths and over block
totals, so no single task holds the histogram.

Null text has length 0. Ids and other columns are not used, repeated rows
count. An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import python_stage, stored
from fraudmart.llm.encoder import Encoder

BLOCK = 512


def _lengths(batches: Iterator[pa.RecordBatch], tokenizer: str, extra: int) -> Iterator[pa.RecordBatch]:
    encode = None
    for batch in batches:
        encode = encode or Encoder(tokenizer)
        n = encode.lengths(batch.column(0).to_pylist()) + extra
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n_tokens"])


def length_histogram(docs: DataFrame, tokenizer: str, *, text_col: str = "text", extra: int = 0) -> DataFrame:
    """``n_tokens, n_docs``: documents per encoded length (plus ``extra``
    tokens each, for instance an end id)."""
    python_stage(docs.sparkSession)
    lengths = docs.select(F.col(text_col).alias("text")).mapInArrow(
        partial(_lengths, tokenizer=tokenizer, extra=extra), "n_tokens long")
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def with_sums(histogram: DataFrame) -> DataFrame:
    """Every length as a context limit: ``n_tokens, n_docs, docs_longer,
    docs_up_to, tokens_up_to, tokens_total, tokens_truncated,
    share_up_to``. ``tokens_truncated`` is what is left when every text is cut at
    ``n_tokens``; ``share_up_to`` is the share of documents no longer than it."""
    h = stored(histogram, "lengths").withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    mass = F.col("n_tokens") * F.col("n_docs")
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum(mass).alias("bt"))
    run = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    blocks = blocks.select("block", F.coalesce(F.sum("bd").over(run), F.lit(0)).alias("d0"),
                           F.coalesce(F.sum("bt").over(run), F.lit(0)).alias("t0"),
                           F.sum("bd").over(total).alias("docs"), F.sum("bt").over(total).alias("tokens_total"))
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    sums = (h.withColumn("d1", F.sum("n_docs").over(inside)).withColumn("t1", F.sum(mass).over(inside))
            .join(blocks, "block")
            .withColumn("docs_up_to", F.col("d0") + F.col("d1"))
            .withColumn("tokens_up_to", F.col("t0") + F.col("t1"))
            .withColumn("docs_longer", F.col("docs") - F.col("docs_up_to")))
    return sums.select("n_tokens", "n_docs", "docs_longer", "docs_up_to", "tokens_up_to", "tokens_total",
                       (F.col("tokens_up_to") + F.col("n_tokens") * F.col("docs_longer")).alias("tokens_truncated"),
                       (F.col("docs_up_to") / F.col("docs")).alias("share_up_to"))


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Answers for any context limits: ``context, docs_longer,
    tokens_truncated``, from the longest length not above each limit."""
    # one pass: for each limit the row of the longest length not above it
    best = [F.max(F.when(F.col("n_tokens") <= int(x), F.struct("n_tokens", "docs_longer", "tokens_up_to")))
            for x in limits]
    answers = F.array(*[F.struct(F.lit(int(x)).cast("long").alias("context"), b.alias("a")) for x, b in zip(limits, best)])
    found = (sums.agg(answers.alias("all"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"))
             .select("docs", F.explode("all").alias("x")).select("docs", "x.context", "x.a"))
    longer = F.coalesce(F.col("a.docs_longer"), F.col("docs"))
    return found.select("context", longer.alias("docs_longer"), (F.coalesce(
        F.col("a.tokens_up_to"), F.lit(0)) + F.col("context") * longer).alias("tokens_truncated"))


def quantile(sums: DataFrame, q: float) -> int | None:
    """The smallest length that at least a share ``q`` of documents do not
    exceed; None for an empty histogram."""
    return sums.filter(F.col("share_up_to") >= q).agg(F.min("n_tokens")).first()[0]
