"""Near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re

from llm_cases import ODD, documents

from fraudmart.llm import minhash
from fraudmart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return set()
    k = min(width, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    near = {i: i for i, _ in sets}

    def find(x):
        while near[x] != x:
            x = near[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                near[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed):
    """Copies, chains of growing edits, case and spacing variants."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    for _ in range(12):
        words = [rng.choice(vocab) for _ in range(rng.choice([2, 30, 120]))]
        for _ in range(rng.randint(1, 9)):
            rows.append((n * 7 % 1009, rng.choice([" ", "\n", "\t "]).join(
                w.upper() if rng.random() < .1 else w for w in words)))
            n += 1
            if rng.random() < .8 and len(words) > 10:
                words = list(words)
                for _ in range(rng.randint(1, 3)):
                    words[rng.randrange(len(words))] = rng.choice(vocab)
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equal_to_brute_force(spark):
    for seed, width, percent in ((1, 3, 85), (2, 5, 80)):
        rows = corpus(seed)
        got = minhash.near_duplicates(documents(spark, rows), width=width, percent=percent).cache()
        assert result(got) == brute(rows, width, percent)
        assert got.filter("kept <> (doc_id = component_id)").count() == 0


def test_bucket_larger_than_a_block(spark, monkeypatch):
    """Many near copies, some not similar enough: blocks are compared in pairs."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = random.Random(3)
    base = [f"v{k}" for k in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(80)] = f"u{rng.random()}"
        rows.append((i, " ".join(words)))
    assert result(minhash.near_duplicates(documents(spark, rows), width=3, percent=85)) == brute(rows, 3, 85)


def test_odd_rows(spark):
    df = documents(spark, ODD).withColumnRenamed("lang", "node").withColumnRenamed("source", "component")
    rows = minhash.near_duplicates(df, width=3, percent=85).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == by[2] == [(0, 1, True)] or by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)]
    assert by[4] == [(1, 4, True)] * 2
    assert sorted(by[None]) == [(0, None, True), (2, None, True)]
    assert by[6] == [(1, 6, True)] and by[7] == [(1, 7, True)]
    assert minhash.near_duplicates(documents(spark, []), width=3).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(10, 60)] + [(5, k) for k in range(100, 160)] + [(7, 7), (None, 3), (60, 59)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 10 for k in range(10, 61)} | {k: 5 for k in [5, *range(100, 160)]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands():
    for percent in (80, 85):
        r = minhash.bands_for(percent, 128)
        assert (1 - (percent / 100) ** r) ** (128 // r) <= 1e-6


def test_an_id_with_several_texts_links_their_classes(spark):
    t, u = (" ".join(f"{c}{k}" for k in range(40)) for c in "tu")
    rows = [(1, t), (2, t), (2, u), (3, u), (4, u + " x"), (5, "other words here"), (2, ""), (6, None), (6, "other words here")]
    out = minhash.near_duplicates(documents(spark, rows), width=3, percent=85).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == sorted(
        [(1, 1, True), (2, 1, False), (2, 1, False), (2, 1, False), (3, 1, False), (4, 1, False), (5, 5, True),
         (6, 5, False), (6, 5, False)])
