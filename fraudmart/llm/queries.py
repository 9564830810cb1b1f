"""Registered queries of the document operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudmart.llm import (alignment, decontaminate, html_extract, language_mixture, license_scan, line_clean, mixing,
                           phrases, pseudonyms, token_histogram, token_store, toxicity)
from fraudmart.llm.common import crc_bucket, read
from fraudmart.llm.minhash import near_duplicates
from fraudmart.llm.oracle import SQL  # noqa: F401  (read by the driver entry)
from fraudmart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: The registered query's key; a production run passes its own secret.
PSEUDONYM_KEY = "registered-query-key"


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_store(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    store = token_store.write_token_store(docs, scratch_path(spark, "tokens"), tokenizer_file(), end_id=END_ID)
    return token_store.digests(store, docs)


def op2_language_mixture(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    bucket = crc_bucket(F.col("doc_id"))
    model = language_mixture.fit(docs, F.coalesce(bucket != 1, F.lit(True)))
    return language_mixture.predict(docs, model).select(
        "doc_id", F.coalesce(bucket == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "langs", "shares")


def op3_decontamination(spark, sf_dir):
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_near_duplicates(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


def op5_line_cleaning(spark, sf_dir):
    judged = line_clean.line_statistics(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "lost_words")


def op6_pseudonyms(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def op7_source_mixing(spark, sf_dir):
    sizes = read(spark, sf_dir, "documents").select(
        "doc_id", "source", F.coalesce(line_clean.n_words(F.col("text")), F.lit(0)).cast("long").alias("size"))
    return mixing.mix(sizes, mixing.cyclic_weights(sizes)).documents.select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op8_license_scan(spark, sf_dir):
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op9_token_histogram(spark, sf_dir):
    lengths = token_histogram.length_histogram(read(spark, sf_dir, "documents"), tokenizer_file(), extra=1)
    return token_histogram.with_sums(lengths)


def op10_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    bucket = crc_bucket(F.col("doc_id"))
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), bucket != 1)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(bucket == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def op11_html_text(spark, sf_dir):
    return html_extract.main_text(read(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op12_tokenizer_alignment(spark, sf_dir):
    return alignment.link_statistics(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                     tokenizer_file("piece_bpe_32k.model"))


def op13_phrase_collocations(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_store,
    op2_language_mixture,
    op3_decontamination,
    op4_near_duplicates,
    op5_line_cleaning,
    op6_pseudonyms,
    op7_source_mixing,
    op8_license_scan,
    op9_token_histogram,
    op10_toxicity,
    op11_html_text,
    op12_tokenizer_alignment,
    op13_phrase_collocations,
)}
