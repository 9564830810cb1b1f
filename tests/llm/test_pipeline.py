"""The pipeline stage by stage against plain Python, and the entry's guard."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import public_tokenizers
from llm_cases import ODD, SF001, documents
from pyspark.sql import functions as F
from test_minhash import brute
from test_native import base_statistics, overlap_pairs

import corpus_pipeline
from fraudmart.llm import encoder
from fraudmart.llm.common import DOCUMENT_COLUMNS, read, stored

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark):
    docs = read(spark, SF001, "documents")
    items = [tuple(r) for r in read(spark, SF001, "benchmark").select("item_id", "text").collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "token_ids"]
    before = {r.doc_id: r for r in docs.collect()}

    docs = stored(steps["quality_rules"](spark, docs, SF001), "t")
    kept = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == DOCUMENT_COLUMNS and docs.count() == len(kept) < len(before)
    for i, r in before.items():
        n, _, _, _, repeated = base_statistics(r.text)
        if n < 50 or 2 * repeated > n:
            assert i not in kept
    good = {r.doc_id for r in read(spark, SF001, "labels").filter("quality = 1").collect()}
    assert all(i in kept or base_statistics(before[i].text)[0] < 50 for i in good)
    for r in kept.values():
        assert r.n_chars == len(r.text) and all(x in before[r.doc_id].text.split("\n") for x in r.text.split("\n"))

    docs = stored(steps["near_duplicates"](spark, docs, SF001), "t")
    groups = brute([(i, r.text) for i, r in kept.items()], 5, 80)
    assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in groups.items() if c == i}

    left = {r.doc_id: r.text for r in docs.collect()}
    docs = stored(steps["decontamination"](spark, docs, SF001), "t")
    hit = {i for i, _ in overlap_pairs([x for x in left.items() if any(t[:40].lower() in x[1].lower() for _, t in items)], items)}
    clean = {r.doc_id: r for r in docs.collect()}
    assert set(clean) == set(left) - hit and docs.count() == len(clean)

    docs = stored(steps["source_mix"](spark, docs, SF001), "t")
    mixed = docs.collect()
    assert docs.columns == DOCUMENT_COLUMNS
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
        assert r == clean[r.doc_id]
    size = {i: len((r.text or "").split()) for i, r in clean.items()}
    assert max(times.values()) <= 3
    assert 0.9 * sum(size.values()) <= sum(size[i] * n for i, n in times.items()) <= sum(size.values())

    out = steps["token_ids"](spark, docs, SF001)
    tok = encoder.Encoder(str(public_tokenizers.path("word_bpe_49k.json"))).tok
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in out.collect())
    at = 0
    for (start, i, n), want in zip(got, sorted(r.doc_id for r in mixed), strict=True):
        assert (start, i) == (at, want) and n == len(tok.encode(clean[i].text, add_special_tokens=False).ids) + 1
        at += n


def test_stages_take_odd_rows(spark, tmp_path):
    long = " ".join(f"w{k}, and" for k in range(60)) + "."
    rows = ODD + [(20, long), (20, long), (21, long + " Twenty more."), (None, long), (22, long.replace("w3", "x"), "en", "s")]
    os.makedirs(tmp_path / "d")
    read(spark, SF001, "benchmark").limit(2).write.parquet(str(tmp_path / "d" / "benchmark.parquet"))
    for rows in (rows, []):
        docs = documents(spark, rows).withColumn("words", F.lit(1)).withColumn("kept", F.lit("x"))
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, str(tmp_path / "d")), "t")
            if name == "near_duplicates" and rows:
                assert sorted((r.doc_id or -1) for r in docs.collect()) == [-1, 20, 22]  # 22 differs too much
        assert docs.count() <= 3 * len(rows)


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    texts = [" ".join(f"{c}{k}" for k in range(80)) + "." for c in "abcdef"]
    passage = read(spark, SF001, "benchmark").orderBy("item_id").first()["text"]
    steps = dict(corpus_pipeline.STAGES)
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1] + " more"), (2, texts[2]), (None, texts[3]), (None, f"{texts[4]} {passage}"),
            (3, texts[5]), (3, f"{texts[5]} {passage}"), (3, texts[5])]
    out = steps["near_duplicates"](spark, documents(spark, rows), SF001)
    assert sorted(r.text for r in out.collect() if r.doc_id in (1, 2)) in (
        sorted([texts[0], texts[1], texts[2]]), sorted([texts[0], texts[1] + " more", texts[2]]))
    out = steps["decontamination"](spark, documents(spark, rows), SF001)
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted(
        (i or 0, t) for i, t in rows if not t.endswith(passage))


def test_mix_of_rows_alike_in_id_source_and_size(spark):
    words = " ".join(["w"] * 10)
    alike = [(None, words, "en", "a")] * 25 + [(None, " ".join([f"v{k}"] * 10), "en", "a") for k in range(15)]
    others = [(k, words, "en", "b") for k in range(100)]
    out = corpus_pipeline.source_mix(spark, documents(spark, alike + others), SF001).collect()
    taken = sum(r.source == "a" for r in out)
    # weights 1 and 2 of 140 documents of one size
    assert abs(taken - 140 / 3) <= 1 and abs(len(out) - 140) <= 1


def test_entry_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "fraudmart"):
        src = os.path.join(REPO, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'fraud_report' in q and 'pipeline' not in q; print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
