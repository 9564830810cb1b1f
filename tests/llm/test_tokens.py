"""Encoder, token store and length histogram against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD, documents
from pyspark.sql import functions as F

from fraudmart.llm import encoder, token_histogram, token_store
from fraudmart.session import scratch_path

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))
BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))

TEXTS = ["İstanbul ẖ H̱ x", "a\x1cb it's THE Kelvin K Σας ΟΔΟΣ", "<|endoftext|> x<|startoftext|>", "", None,
         " a b..., 12,3. don't. é é,", "ﬁ ǅ ŉ ʼn ª. ½,", "ᄀ ᅡ 한글。 ́x", "x. y, z!. a!, b\n.\n, q.\n1999, 4.0. ok",
         "a\xa0b.\xa0c \x85, d", "½. µ, ².", "don't, it's. 'S 'T. . , .", "a.\tb,\rc.\x0bd,\x0ce", "É. ÀB, ÿ.",
         "q .", "!", ".", ",", " . ", " ,", "w. " * 5000]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_tokenizer(path, monkeypatch):
    monkeypatch.setattr(encoder, "MEMO_CHUNKS", 20)  # forgets all the time
    e = encoder.Encoder(path)
    assert e.by_chunk == (path == WORDS)
    for _ in range(3):
        for k in range(0, len(TEXTS), 4):
            part = TEXTS[k:k + 4]
            want = [e.tok.encode(t or "", add_special_tokens=False).ids for t in part]
            assert [x.tolist() for x in e(part)] == want
            assert e.lengths(part).tolist() == [len(x) for x in want]


def test_a_worker_loads_the_tokenizer_once_per_run(tmp_path, monkeypatch):
    import pyarrow as pa
    loaded = []

    class Counted(encoder.Encoder):
        def __init__(self, path):
            loaded.append(path)
            super().__init__(path)

    class Task:
        partitionId = taskAttemptId = staticmethod(lambda: len(loaded))
        get = classmethod(lambda cls: cls)

    monkeypatch.setattr(encoder, "Encoder", Counted)
    monkeypatch.setattr(token_store, "Encoder", Counted)
    monkeypatch.setattr(token_store, "TaskContext", Task)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["a b", None, "a, c"]})
    for run in ("a", "b"):
        (tmp_path / run).mkdir()
        places = [[b.to_pydict()["n_tokens"] for b in token_store._write_ids(iter([batch]), str(tmp_path / run), WORDS, 2, 2)]
                  for _ in range(3)]
        assert places == [[[3, 1, 4]]] * 3
    assert loaded == [WORDS, WORDS]  # six tasks, two runs


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    table = token_store.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert len(token_store.PerfectHash.build(keys[:0]).slots(keys)) == len(keys)


def test_store_round_trip(spark):
    rows = ODD + [(i * 3 + 50, f"Some text, number {i}. " * (i % 7)) for i in range(200)] + [(9, t) for t in TEXTS]
    docs = documents(spark, rows).withColumn("shard", F.lit("x")).withColumn("offset", F.lit(1))
    store = token_store.write_token_store(docs, scratch_path(spark, "t"), WORDS, end_id=2, keys_per_index=50)
    assert store.index_shards > 1 and store.width == 2
    tok = encoder.Encoder(WORDS).tok
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = [tuple(r)[:4] for r in token_store.digests(store, docs).collect()]
    key = lambda r: (r[1], r[2])
    assert sorted(got, key=key) == sorted(want, key=key)

    # keyed access: several rows of a key, unknown keys, the ids themselves
    keys = spark.createDataFrame([(9,), (53,), (-5,), (10**12,), (None,)], "doc_id long")
    found = token_store.fetch(store, token_store.locate(store, keys)).collect()
    assert sorted(r.doc_id for r in found) == [9] * len(TEXTS) + [53]
    ids = {r.doc_id: r.ids for r in found}
    assert ids[53] == tok.encode(rows[len(ODD) + 1][1], add_special_tokens=False).ids + [2]


def test_empty_store(spark):
    docs = documents(spark, [])
    store = token_store.write_token_store(docs, scratch_path(spark, "t"), WORDS, end_id=2)
    assert token_store.digests(store, docs).count() == 0
    assert token_store.locate(store, spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_histogram(spark, monkeypatch):
    monkeypatch.setattr(token_histogram, "BLOCK", 8)
    rows = ODD + [(i, "word, " * (i % 37)) for i in range(300)]
    docs = documents(spark, rows).withColumnRenamed("lang", "n_tokens")
    tok = encoder.Encoder(WORDS).tok
    n = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    sums = token_histogram.with_sums(token_histogram.length_histogram(docs, WORDS, extra=1)).cache()
    for r in sums.collect():
        assert r.n_docs == n.count(r.n_tokens)
        assert r.docs_longer == sum(x > r.n_tokens for x in n) and r.docs_up_to == len(n) - r.docs_longer
        assert r.tokens_total == sum(n) and r.tokens_up_to == sum(x for x in n if x <= r.n_tokens)
        assert r.tokens_truncated == sum(min(x, r.n_tokens) for x in n)
        assert r.share_up_to == r.docs_up_to / len(n)
    assert sums.count() == len(set(n))
    limits = [0, 1, 5, 17, 18, 100, 10**9]
    got = {r.context: (r.docs_longer, r.tokens_truncated) for r in token_histogram.at_limits(sums, limits).collect()}
    assert got == {c: (sum(x > c for x in n), sum(min(x, c) for x in n)) for c in limits}
    assert token_histogram.quantile(sums, 0.5) == n[-(-len(n) // 2) - 1]
    empty = token_histogram.with_sums(token_histogram.length_histogram(documents(spark, []), WORDS))
    assert empty.count() == 0 and token_histogram.quantile(empty, 0.5) is None
    assert token_histogram.at_limits(empty, [3]).collect()[0][1:] == (0, 0)
