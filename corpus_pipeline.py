"""The corpus pipeline: documents in, a token store out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All stages but the
last return the columns of documents:

1. quality rules: documents that fail the line rules or the base rules go; the
   others keep the lines that passed.
2. near-duplicates: five-word shingles, similarity 0.8; one row of each group
   stays, the one with the smallest id.
3. benchmark decontamination: documents that hold a benchmark passage go.
4. mixing to source weights: documents are taken as often as the mix takes them.
5. token ids: a token store is written; one row per stored document.

Rows that repeat an id are judged, dropped and mixed each by its own text. Rows
without an id are no duplicates of anything; the other stages judge them like any row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import decontaminate, line_clean, minhash, mixing, token_store
from fraudmart.llm.common import DOCUMENT_COLUMNS, read, stored
from fraudmart.llm.queries import END_ID, tokenizer_file
from fraudmart.session import scratch_path


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*DOCUMENT_COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = line_clean.line_statistics(_documents(docs)).filter("kept")
    return _documents(judged.drop("text").withColumnRenamed("clean_text", "text")
                      .withColumn("n_chars", F.length("text").cast("long")))


def _with_row_key(docs: DataFrame) -> DataFrame:
    """The documents with ``row_key`` and ``repeats``. The key is the id; of rows that
    repeat an id all but those of one content, and rows without an id, get a number
    from their whole content instead. Only rows alike in every column share a key."""
    rows = _documents(docs).withColumn(
        "content", F.lit(1 << 61) + F.shiftrightunsigned(F.xxhash64(*DOCUMENT_COLUMNS), 3))
    again = stored(rows.filter("doc_id is not null").groupBy("doc_id")
                   .agg(F.count("*").alias("n"), F.min("content").alias("first")).filter("n > 1").drop("n"), "repeated-ids")
    other = F.col("doc_id").isNull() | (F.col("first") != F.col("content"))
    return rows.join(again, "doc_id", "left").select(
        *DOCUMENT_COLUMNS, F.when(other, F.col("content")).otherwise(F.col("doc_id")).alias("row_key"),
        (F.col("doc_id").isNull() | F.col("first").isNotNull()).alias("repeats"))


def _once(keyed: DataFrame) -> DataFrame:
    """One of the rows that are alike in every column."""
    return keyed.filter("not repeats").unionByName(
        keyed.filter("repeats").dropDuplicates(["row_key", *DOCUMENT_COLUMNS]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _with_row_key(docs)
    named = keyed.filter("doc_id is not null")
    verdict = minhash.near_duplicates(named, "row_key", width=5, percent=80)
    gone = verdict.filter("not kept").select(F.col("doc_id").alias("row_key")).distinct()
    left = _once(named.join(gone, "row_key", "left_anti"))
    return _documents(left).unionByName(_documents(docs).filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _with_row_key(docs)
    found = decontaminate.overlaps(keyed.select(F.col("row_key").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    hits = stored(found.select(F.col("doc_id").alias("row_key")).distinct(), "contaminated")
    return _documents(keyed.join(hits, "row_key", "left_anti"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size = F.coalesce(line_clean.n_words(F.col("text")), F.lit(0)).cast("long")
    keyed = _with_row_key(docs)
    sizes = stored(keyed.select(F.col("row_key").alias("doc_id"), "source", size.alias("size")), "sizes")
    taken = mixing.mix(sizes, mixing.cyclic_weights(sizes)).documents
    # rows with one key are alike, so the row comes out as often as the mix takes them together
    times = (taken.groupBy(F.col("doc_id").alias("row_key")).agg(F.sum("times").cast("int").alias("times"))
             .filter("times > 0"))
    return _documents(_once(keyed).join(times, "row_key").withColumn("pass", F.explode(F.sequence(F.lit(1), "times"))))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    store = token_store.write_token_store(docs, scratch_path(spark, "pipeline-tokens"), tokenizer_file(),
                                          end_id=END_ID)
    return token_store.digests(store, docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("source_mix", source_mix), ("token_ids", token_ids)]

#: Signatures, token ids and files cannot be written as SQL; tests compare the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
