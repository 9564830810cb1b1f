"""Mixing against a plain simulation; language and toxicity models against
brute force and held-out rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from llm_cases import ODD, SF001, documents
from pyspark.sql import functions as F

from fraudmart.llm import language_mixture as lm
from fraudmart.llm import mixing, toxicity
from fraudmart.llm.common import crc_bucket, read


def simulate(rows, weights, budget, passes):
    """rows: (doc_id, source, size, copy)"""
    sizes = {}
    for _, s, n, _ in rows:
        sizes[s] = sizes.get(s, 0) + n
    full = {s for s in sizes if not weights.get(s)}
    while True:
        left = budget - sum(passes * sizes[s] for s in full if weights.get(s))
        share = sum(weights[s] for s in sizes if s not in full)
        over = {s for s in sizes if s not in full and passes * sizes[s] * share < weights[s] * left}
        if not over:
            break
        full |= over
    target = {s: 0.0 if not weights.get(s) else float(passes * sizes[s]) if s in full else weights[s] * left / share
              for s in sizes}
    line = []
    for p in range(passes):
        for s in sizes:
            if not target[s]:
                continue
            at, own = p * sizes[s], []
            for i, _, n, c in (r for r in rows if r[1] == s):
                text = ":".join(str(x) for x in (p, i, n, c) if x is not None)
                own.append((int(hashlib.md5(text.encode()).hexdigest()[:15], 16), i, n, c))
            for k, i, n, c in sorted(own, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3])):
                at += n
                line.append((at / target[s], "" if s is None else "=" + s, p, k, i, n, c, s))
    taken, run = {}, 0
    for r in sorted(line, key=lambda r: (*r[:4], r[4] is not None, r[4] or 0, *r[5:7])):
        run += r[5]
        if run <= budget:
            taken[(r[4], r[7], r[5], r[6])] = taken.get((r[4], r[7], r[5], r[6]), 0) + r[5]
    return {(i, s, n, c): (sizes[s], target[s], taken.get((i, s, n, c), 0)) for i, s, n, c in rows}


def test_mix_equals_simulation(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "b", "c", None, "é"]), rng.choice([0, 1, 5, 40]), 1) for i in range(300)]
    rows += [(7000, "tiny", 3, 1), (None, "a", 5, 1), (8000, "b", 9, 1), (8000, "b", 9, 2), (9000, "none", 0, 1)]
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, source string, size long").withColumn(
        "weight", F.lit(1)).withColumn("pass", F.lit("x"))
    weights = mixing.cyclic_weights(df)
    by = {r.source: r.weight for r in weights.collect()}
    assert [by[s] for s in ("a", "b", "c", "none", "tiny", "é", None)] == [1, 2, 3, 1, 2, 3, 1]
    total = sum(r[2] for r in rows)
    for budget in (None, 500):
        m = mixing.mix(df, weights, budget=budget)
        got = {(r.doc_id, r.source, r["size"], r.copy): (r.source_size, r.target, r.taken) for r in m.documents.collect()}
        assert got == simulate(rows, by, total if budget is None else budget, 3)
        sequence = m.sequence.orderBy("finish").collect()
        assert sum(r["size"] for r in sequence) == sum(v[2] for v in got.values()) <= (budget or total)
        assert all(v[2] <= 3 * k[2] for k, v in got.items())
    assert mixing.mix(df.limit(0), weights).documents.count() == 0
    assert mixing.mix(df, weights.limit(0)).documents.agg(F.sum("taken")).first()[0] == 0


def test_em_recovers_a_mixture():
    rng = np.random.default_rng(0)
    table = rng.dirichlet(np.ones(50) * 0.2, 3)
    draws = np.concatenate([rng.choice(50, 700, p=table[0]), rng.choice(50, 300, p=table[2])])
    p = lm.likelihoods(np.log(table + 1e-12))[draws]
    keep, share = lm.infer(p, penalty=2)
    assert keep.tolist() == [0, 2] and abs(share[0] - 0.7) < 0.06
    w, ll = lm.proportions(p, rounds=500)
    for other in ([0.5, 0, 0.5], [0.6, 0.1, 0.3], [0.8, 0, 0.2]):  # no weights are likelier
        assert ll >= np.log(p @ np.array(other)).sum() - 1e-2 * len(draws) ** 0.5


def test_language_held_out(spark):
    docs = read(spark, SF001, "documents")
    model = lm.fit(docs, crc_bucket(F.col("doc_id")) != 1)
    odd = documents(spark, ODD).withColumnRenamed("lang", "score").withColumnRenamed("source", "langs")
    got = lm.predict(odd, model).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert (r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    right = (lm.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
             .filter(crc_bucket(F.col("doc_id")) == 1).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))))
    assert right.first()[0] > 0.95
    none = lm.fit(documents(spark, ODD), F.lit(True))
    assert {r.lang_pred for r in lm.predict(docs.limit(5), none).collect()} == {"und"}
    assert lm.predict(docs.limit(0), model).count() == 0


def test_model_stays_within_its_bytes(spark):
    rows = [(i, f"text of language {i}", f"l{i}") for i in range(40)]
    langs, logs, bits = lm.fit(documents(spark, rows), F.lit(True), model_bytes=1 << 16)
    assert len(langs) == 40 and logs.nbytes <= 1 << 16 and bits == 8


def test_block_max_index_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(700):
        ids = np.unique(rng.integers(0, 90, rng.integers(0, 12)))
        w = rng.random(len(ids)) + 0.01
        vectors.append((ids, w / np.sqrt(w @ w) if len(w) else w))
    vectors += vectors[:50]  # ties
    index = toxicity.BlockMaxIndex(vectors, 90)
    dense = np.zeros((len(vectors), 90))
    for k, (i, w) in enumerate(vectors):
        dense[k, i] = w.astype(np.float32)
    for k in range(0, len(vectors), 7):
        ids, w = vectors[k]
        cos = np.round(dense[:, ids] @ w, 12)
        for without in (-1, k):
            if without >= 0:
                cos[k] = 0
            want = [e for e in np.lexsort((np.arange(len(cos)), -cos))[:15] if cos[e] > 0]
            e, s = index.top(ids, w, 15, without=without)
            assert e.tolist() == want and np.allclose(s, cos[want])


def test_toxicity(spark):
    rng = random.Random(6)
    vocab = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocab) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[3:3] = rng.sample(["scoundrel", "numbskull", "wretch", "cretin"], 2)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = documents(spark, rows + [(r[0] + 1000, r[1]) for r in ODD if r[0]] + [(None, "you numbskull wretch")])
    marks = spark.createDataFrame(labels + [(0, 0), (None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in toxicity.score(docs.withColumnRenamed("lang", "evidence"), model).collect()}
    wrong = [i for i in range(400) if i % 3 == 1 and (got[i].score >= 0.7) != (i % 4 == 0)]
    assert len(wrong) <= 2 and got[None].score >= 0.7
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1001].score == got[1002].score < 0.3 and got[1001].evidence == []
    assert got[None].evidence[0].toxic == 1 and got[None].evidence[0].cosine > 0.5
    one = toxicity.fit(docs, marks.filter("toxic = 1"), F.lit(True))
    assert {r.score for r in toxicity.score(docs.limit(9), one).collect()} == {1.0}
    none = toxicity.fit(docs, marks.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(docs.limit(9), none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_many_slightly_preferred_words_are_evidence(spark):
    rng = random.Random(8)
    hints = [f"hint{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]  # 36 % of toxic, 15 % of clean documents
    rows = [(i, " ".join(["common", *(w for w in hints if rng.random() < (0.36 if i % 2 else 0.15))]), i % 2)
            for i in range(1200)]
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    model = toxicity.fit(docs, marks, F.col("doc_id") < 900)
    assert set(hints) <= set(model.vocabulary)
    got = {r.doc_id: r.score for r in toxicity.score(docs.filter("doc_id >= 900"), model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 900]) > 0.9


def test_a_batch_finds_what_each_query_finds():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(600):
        ids = np.unique(rng.integers(0, 40, rng.integers(0, 30)))
        w = rng.random(len(ids)) + 0.01
        vectors.append((ids, w / np.sqrt(w @ w) if len(w) else w))
    index = toxicity.BlockMaxIndex(vectors, 40)
    dense = np.zeros((len(vectors), 40))
    for k, (i, w) in enumerate(vectors):
        dense[k, i] = w.astype(np.float32)
    for k, (e, s) in enumerate(index.top_many(vectors, 15, list(range(len(vectors))))):
        cos = np.round(dense[:, vectors[k][0]] @ vectors[k][1], 12)
        cos[k] = 0
        assert e.tolist() == [x for x in np.lexsort((np.arange(len(cos)), -cos))[:15] if cos[x] > 0]


def test_isotonic():
    x, y = np.array([0.1, 0.2, 0.2, 0.5, 0.9]), np.array([0, 1, 0, 1, 1.0])
    knots, values = toxicity.isotonic(x, y, np.ones(5))
    assert (np.diff(values) >= 0).all() and values[0] == 0 and values[-1] == 1
    assert np.interp(0.2, knots, values) == 0.5


def test_equal_draws_count_once_with_their_number():
    """A text's repeated n-grams enter EM as one row each, with the same outcome."""
    rng = np.random.default_rng(1)
    table = rng.dirichlet(np.ones(40) * 0.3, 4)
    for parts in ((500, 0, 120, 0), (300, 300, 0, 200), (1, 0, 0, 0)):
        draws = np.concatenate([rng.choice(40, m, p=q) for m, q in zip(parts, table)])
        like = lm.likelihoods(np.log(table + 1e-9))
        times = np.bincount(draws)
        bins = np.flatnonzero(times)
        for got, want in zip(lm.infer(like[bins], times=times[bins].astype(float)), lm.infer(like[draws])):
            assert np.allclose(got, want)
