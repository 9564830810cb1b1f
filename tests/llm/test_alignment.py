"""Cross-tokenizer alignment against a plain merge of token spans."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS, ODD, SF001, documents
from pyspark.sql import functions as F

from fraudmart.llm import alignment
from fraudmart.llm.common import read, stored

A_FILE = str(public_tokenizers.path("byte_bpe_50k.json"))
B_FILE = str(public_tokenizers.path("piece_bpe_32k.model"))


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """Per text: ids, links and groups by comparing all spans; then corpus counts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_FILE), SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    byte_of = alignment._byte_alphabet()
    rows = []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        xb = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in x]
        yb = [alignment._piece_bytes(b, i) for i in y]
        if not t or b"".join(xb) != (" " + t).encode() or b"".join(yb) != (" " + t).encode():
            rows.append(([], [], [], ""))
            continue
        xs, ys, links, first = spans(xb), spans(yb), [], 0
        for i, (s, e) in enumerate(xs):
            while ys[first][1] <= s:
                first += 1
            j = first
            while j < len(ys) and ys[j][0] < e:
                links.append((x[i], y[j]))
                j += 1
        groups, p, q = [], 0, 0
        for cut in sorted({e for _, e in xs} & {e for _, e in ys}):
            u, v = p, q
            while p < len(xs) and xs[p][1] <= cut:
                p += 1
            while q < len(ys) and ys[q][1] <= cut:
                q += 1
            groups.append(",".join(map(str, x[u:p])) + "|" + ",".join(map(str, y[v:q])))
        rows.append((x, y, links, ";".join(groups)))
    count = collections.Counter(link for r in rows for link in r[2])
    best = collections.Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(len(x), len(y), g.count(";") + 1 if g else 0, len(links), sum(count[k] == best[k[1]] for k in links),
             sum(count[k] for k in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for x, y, links, g in rows]


def got(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"],
                   r["count_sum"], r["groups_sha256"]) for r in df.collect())


def want(rows):
    texts = [r[1] for r in rows]
    return sorted((r[0] is None, r[0] or 0, *p) for r, p in zip(rows, plain(texts)))


def test_whole_table_equals_plain(spark):
    docs = read(spark, SF001, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(alignment.link_statistics(docs, A_FILE, B_FILE)) == want(rows)


def test_odd_rows_special_strings_and_clashing_columns(spark):
    rows = [*ODD, (20, "<|endoftext|> <s> a</s><unk>"), (21, "▁a"), (22, "  a \n\t b  "), (23, "日本語 \U0001f600é \x00"),
            (24, "a" * 3000 + " " * 2000 + "\r\n" * 700)]
    docs = documents(spark, rows).withColumns({"block": F.lit("x"), "pairs": F.lit(1), "n_a": F.lit(7), "pos": F.lit(0)})
    out = got(alignment.link_statistics(docs, A_FILE, B_FILE))
    assert out == want(rows)
    assert (False, 21, 0, 0, 0, 0, 0, 0, "") in out  # a literal U+2581 reads back as a space


def test_empty_table(spark):
    assert alignment.link_statistics(spark.createDataFrame([], DOCUMENTS), A_FILE, B_FILE).count() == 0


def test_many_blocks_give_the_same_counts(spark):
    rows = [(i, f"some words {i % 7} of a text, repeated {i % 3}") for i in range(300)]
    docs = documents(spark, rows).repartition(5)
    aligned = stored(alignment.align(docs, A_FILE, B_FILE, block_chars=500), "blocks")
    assert aligned.select("block").distinct().count() > 20
    out = alignment.with_link_counts(aligned, alignment.pair_counts(aligned))
    digest = F.sha2(F.col("groups"), 256).alias("groups_sha256")
    assert got(out.select("*", digest)) == want(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=900), st.randoms(use_true_random=False)), max_size=5))
def test_lockstep_links_are_the_overlapping_spans(cases):
    a_ends, b_ends, a_from, b_from, expected, base = [], [], [0], [0], [], 0
    for sizes, rnd in cases:
        total, other = sum(sizes), []
        while sum(other) < total:
            other.append(min(rnd.randint(1, 6), total - sum(other)))
        x, y = np.cumsum(sizes) + base, np.cumsum(other) + base
        for i, e in enumerate(x):
            s = x[i - 1] if i else base
            for j, f in enumerate(y):
                if max(s, y[j - 1] if j else base) < min(e, f):
                    expected.append((len(a_ends) + i, len(b_ends) + j, bool(e == f)))
        a_ends += x.tolist()
        b_ends += y.tolist()
        a_from.append(len(a_ends))
        b_from.append(len(b_ends))
        base += total
    i, j, cut = alignment.lockstep(*(np.array(v, np.int64) for v in (a_ends, a_from, b_ends, b_from)))
    assert sorted(zip(i.tolist(), j.tolist(), cut.tolist())) == expected


def test_long_runs_and_spelling():
    old = re.compile(r"\S{600}|\s{600}")
    for n in (599, 600, 601):
        for text in ("a" * n, " \t" * (n // 2) + " " * (n % 2), "b " + " " * n + " c", "a " * n, "é" * n + "\n", "x" + "\x1c" * n):
            assert alignment.has_long_run(text) == (old.search(text) is not None)
    assert not alignment.has_long_run("")
    # a text the tokens do not spell loses its tokens, its neighbours keep theirs
    texts = ["a plain text", "a ▁ b", "", None, "café\U0001f600", "a plain text"]
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found, _ = alignment.align_texts(texts, *files)
    assert [n > 0 for n in found["n_a"]] == [n > 0 for n in found["n_b"]] == [True, False, False, False, True, True]
    a, b, spelling, _ = alignment._tokenizers(*files)
    for tokenizer, spell in zip((a, b), spelling):
        ids = tokenizer.encode("plain café\U0001f600")
        ends, data = alignment._spelled(spell, ids)
        assert data == b"".join(tokenizer.table[i] for i in ids) and ends.tolist() == [
            sum(len(tokenizer.table[i]) for i in ids[:k]) for k in range(len(ids) + 1)]
