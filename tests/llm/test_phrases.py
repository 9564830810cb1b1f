"""Collocations against plain counting; the parse against the pieces it cuts."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS, ODD, SF001, documents
from pyspark.sql import functions as F

from fraudmart.llm import phrases
from fraudmart.llm.common import read
from fraudmart.llm.oracle import SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for p in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        if words := re.findall("[^ \t]+", p):
            yield words


def plain(rows, least, percent, top):
    """rows of (lang, text)"""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if any(x == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
               and 100 * b >= percent * a for (x, q), b in found.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, k + 1, *r[1:]) for k, r in enumerate(own)]
    return sorted(ranked)


def got(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def shared_text(seed, n_docs=120):
    rnd = random.Random(seed)
    common = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(10, 60))) for _ in range(4)]
    rows = []
    for i in range(n_docs):
        own = " ".join(rnd.choice(["New York", "the", "of the", "x", "y,", "z.", "a b c d", str(rnd.randint(0, 30))])
                       for _ in range(rnd.randint(0, 60)))
        rows.append((i, f"{own} {rnd.choice(common)} {own}\t{rnd.choice(common)}!", rnd.choice(["en", "de", None, "und"])))
    return rows


def test_equals_plain_counting(spark):
    rows = shared_text(1)
    for least, top in ((3, 2000), (10, 7)):
        out = got(phrases.collocations(documents(spark, rows).repartition(3), least=least, top=top))
        assert out == plain([(r[2], r[1]) for r in rows], least, 80, top)
    assert len(out) > 7


def test_beyond_the_broadcast_bounds(spark, monkeypatch):
    rows = shared_text(2)
    monkeypatch.setattr(phrases, "BLOCK_BITS", 3)
    want = plain([(r[2], r[1]) for r in rows], 4, 80, 2000)
    for bounds in ({"most_words": 0}, {"most_pairs": 0}, {"most_words": 0, "most_pairs": 0}):
        assert got(phrases.collocations(documents(spark, rows), least=4, **bounds)) == want


def test_odd_rows_clashing_columns_and_repeats(spark):
    rows = [*ODD, *ODD, (30, "B\x0bc\x0cd  e f\tÀ b. B c", None), (31, "word " * 200)]
    docs = documents(spark, rows).withColumns({"chunk": F.lit("x"), "block": F.lit(1), "word": F.lit("w"), "id": F.lit(4), "phrase": F.lit(2), "n": F.lit(3)})
    want = plain([(r[2] if len(r) > 2 else None, r[1]) for r in rows], 2, 80, 2000)
    assert got(phrases.collocations(docs, least=2)) == want


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_score_beyond_64_bits(spark):
    big = 1 << 62
    rows = [("en", "a", big + 5), ("en", "b", big), ("en", "a b", big - 7)]
    out = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, f long")).collect()
    assert [(r["a"], r["l"], r["r"], r["score"]) for r in out] == [
        (big - 7, big + 5, big, 2000000 * (big - 7) // (2 * big + 5))]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    sql = SQL["op13_phrase_collocations"].replace("f >= 30", "f >= 5")
    want = sorted(con.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({sql})").fetchall())
    assert got(phrases.collocations(read(spark, SF001, "documents"), least=5)) == want and len(want) > 100


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=400))
def test_chunks_hold_every_phrase_once(ids):
    from_chunks, direct = Counter(), Counter()
    for chunk, closed in phrases.cut(np.array(ids, np.int64)):
        words = np.frombuffer(chunk, "<i4").tolist()
        for i in range(len(words) - (phrases.WINDOW if closed else 0)):
            for k in range(2, min(4, len(words) - i) + 1):
                from_chunks[tuple(words[i:i + k])] += 1
    for i in range(len(ids)):
        for k in range(2, 5):
            if i + k <= len(ids) and 0 not in ids[i:i + k]:
                direct[tuple(ids[i:i + k])] += 1
    assert from_chunks == direct
