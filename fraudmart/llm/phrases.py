"""Phrase collocation mining by prefix-free parsing.

A text (A-Z lower-cased) is split at ``[.,;:!?]`` and line ends into pieces, a piece at
blanks and tabs into words. Per language (null: ``und``) phrases of two to four words
that occur at least ``least`` times are scored by their weakest cut.

Parsing: words are counted first. A word that occurs less than ``least`` times is in no
phrase that counts, so pieces fall into runs of frequent words, held as numbers. A
window of three words whose hash is divisible by ``TRIGGER`` starts a new chunk, and
the chunk before it ends with that same window. Which windows start chunks depends on
their words alone, so a passage that many documents share is cut alike everywhere and
becomes the same chunks; chunks overlap by three words. The dictionary holds each
distinct chunk once, with its number of occurrences. Phrases are counted inside
distinct chunks, times that number. A phrase belongs to the chunk in which it starts
before the closing window (the last chunk of a run has no closing window), so what
lies in an overlap is counted once.

Counting goes by length: pairs, then phrases of three and four words. The numbers of
frequent words go to the parsing tasks as a broadcast while they are at most
``most_words``; beyond that each block of documents gets those of its own words by a
join (one row per block and distinct word, so no word is a hot key). Frequent pairs
prune the longer phrases while they are at most ``most_pairs``; beyond that all
phrases of frequent words are counted. Both ways give the same rows: what is pruned
cannot occur ``least`` times.

Null, empty and blank texts have no words. Repeated rows count each time.
Languages are compared as strings; a null language and ``und`` are one. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import python_stage, stored

#: Words of a trigger window, and of the overlap of chunks: one less than the
#: longest phrase.
WINDOW = 3
LONGEST = WINDOW + 1
#: One window in so many starts a chunk.
TRIGGER = 12
#: Bounds of the two broadcasts: about 60 MB of words and 32 MB of pairs.
MOST_WORDS = 1 << 19
MOST_PAIRS = 1 << 22
#: Documents per block where words come back by a join, as a power of two.
BLOCK_BITS = 11
#: Distinct entries a counting task holds before it hands them on.
HELD = 400_000
#: Words of chunks that are counted together.
COUNTED = 3_000_000
PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

WORD = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
CHUNK = pa.schema([("chunk", pa.binary()), ("closed", pa.bool_()), ("n", pa.int64())])
PHRASE = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int64())])


def _schema(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.bool_(): "boolean", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def pieces_of(text: str | None) -> list[list[bytes]]:
    return [p.split() for p in PIECE_END.split((text or "").encode().lower())]


# -- words

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out():
        found = [(lang, w.decode(), n) for lang, c in held.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), WORD)], schema=WORD)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = held.setdefault(lang, Counter())
            for p in pieces_of(text):
                own.update(p)
        if sum(map(len, held.values())) > HELD:
            yield out()
            held.clear()
    if any(held.values()):
        yield out()


def word_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(words, totals)``: ``lang``, ``word``, ``f`` of the frequent words, and ``lang``, ``n``.
    Rare words leave one sum per language and task behind."""
    counted = docs.mapInArrow(_count_words, _schema(WORD)).groupBy("lang", "word").agg(F.sum("n").alias("f"))
    kept = F.when(F.col("f") >= least, F.col("word"))
    table = stored(counted.groupBy("lang", kept.alias("word")).agg(F.sum("f").alias("f")), "words")
    return table.filter("word is not null"), table.groupBy("lang").agg(F.sum("f").alias("n"))


def _numbered(words: DataFrame) -> DataFrame:
    """The words with a number each, from 1 on without gaps: their place in the
    partition plus the sizes of those before it (one row per partition)."""
    at = F.monotonically_increasing_id()
    placed = stored(words.withColumns({"part": F.shiftright(at, 33), "row": at.bitwiseAND((1 << 33) - 1)}), "placed-words")
    parts = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select("lang", "word", "f", (F.col("start") + F.col("row") + 1).alias("id"))


# -- chunks

def cut(ids: np.ndarray) -> Iterator[tuple[bytes, bool]]:
    """The chunks of word numbers in which 0 ends a run, each with whether it ends
    with the next chunk's window. Runs of one word hold no phrase and give none."""
    ids = np.concatenate([[0], ids, [0]])
    ends = np.flatnonzero(ids == 0)
    first, last = ends[:-1] + 1, ends[1:]  # runs: [first, last)
    long_enough = last - first >= 2
    first, last = first[long_enough], last[long_enough]
    if not len(first):
        return
    window = np.zeros(len(ids), np.uint64)
    for i in range(WINDOW):
        window[:len(ids) - i] += ids[i:].astype(np.uint64) * _MIX[i]
    window ^= window >> np.uint64(31)
    starts = np.flatnonzero((window * _MIX[0] >> np.uint64(33)) % np.uint64(TRIGGER) == 0)
    run = np.searchsorted(first, starts, side="right") - 1
    inside = (run >= 0) & (starts > first[run]) & (starts + WINDOW <= last[run])
    starts, run = starts[inside], run[inside]
    begin = np.concatenate([first, starts])
    order = np.argsort(begin, kind="stable")
    begin, of = begin[order], np.concatenate([np.arange(len(first)), run])[order]
    closed = np.append(of[1:] == of[:-1], False)
    end = np.where(closed, np.append(begin[1:], 0) + WINDOW, last[of])
    data = ids.astype("<i4").tobytes()
    for b, e, c in zip((begin * 4).tolist(), (end * 4).tolist(), closed.tolist()):
        yield data[b:e], c


def _ids_of(texts: list, langs: list, known: dict[str, dict[bytes, int]]) -> np.ndarray:
    out: list[int] = []
    for text, lang in zip(texts, langs):
        if of := known.get(lang):
            for p in pieces_of(text):
                out.extend([of.get(w, 0) for w in p])
                out.append(0)
    return np.array(out, np.int64)


def _chunk_rows(held: Counter) -> dict:
    return {"chunk": pa.array([k[0] for k in held], pa.binary()), "closed": pa.array([k[1] for k in held], pa.bool_()),
            "n": pa.array(list(held.values()), pa.int64())}


def _by_lang(langs: list, words: list, ids: list) -> dict[str, dict[bytes, int]]:
    known: dict[str, dict[bytes, int]] = {}
    for lang, w, i in zip(langs, words, ids):
        known.setdefault(lang, {})[w.encode()] = i
    return known


def _parse_with(sent) -> Callable:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _by_lang(*sent.value), Counter()
        for batch in batches:
            held.update(cut(_ids_of(batch.column(1).to_pylist(), batch.column(0).to_pylist(), known)))
            if len(held) > HELD:
                yield pa.RecordBatch.from_pydict(_chunk_rows(held), schema=CHUNK)
                held.clear()
        if held:
            yield pa.RecordBatch.from_pydict(_chunk_rows(held), schema=CHUNK)
    return parse


def _parse_block(docs: pa.Table, words: pa.Table) -> pa.Table:
    known = _by_lang(*[words.column(c).to_pylist() for c in ("lang", "word", "id")])
    ids = _ids_of(docs.column("text").to_pylist(), docs.column("lang").to_pylist(), known)
    return pa.Table.from_pydict(_chunk_rows(Counter(cut(ids))), schema=CHUNK)


def _count_words_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {(b, lang, w) for b, lang, text in zip(*[batch.column(i).to_pylist() for i in range(3)])
                 for p in pieces_of(text) for w in p}
        yield pa.RecordBatch.from_pydict({"block": [k[0] for k in found], "lang": [k[1] for k in found],
                                          "word": [k[2].decode() for k in found]})


def dictionary(docs: DataFrame, words: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """``chunk`` (word numbers, 4 bytes each), ``closed`` and ``n`` of each distinct chunk."""
    spark = docs.sparkSession
    if words.count() <= most_words:
        rows = words.select("lang", "word", "id").toArrow()
        sent = spark.sparkContext.broadcast([rows.column(c).to_pylist() for c in ("lang", "word", "id")])
        chunks = docs.mapInArrow(_parse_with(sent), _schema(CHUNK))
    else:
        blocks = stored(docs.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "document-blocks")
        own = (blocks.select("block", "lang", "text").mapInArrow(_count_words_of_blocks, "block long, lang string, word string")
               .distinct().join(words, ["lang", "word"]).select(F.col("block").alias("of_block"), "lang", "word", "id"))
        chunks = blocks.groupBy("block").cogroup(own.groupBy("of_block")).applyInArrow(_parse_block, _schema(CHUNK))
    return chunks.groupBy("chunk", "closed").agg(F.sum("n").alias("n"))


# -- phrases

def _summed(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Equal (hi, lo) added up."""
    order = np.lexsort((lo, hi))
    hi, lo, n = hi[order], lo[order], n[order]
    new = np.ones(len(hi), bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    at = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays([pa.array(hi[at]), pa.array(lo[at]), pa.array(np.add.reduceat(n, at))], schema=PHRASE)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers of many chunks, zeros between them, and how often a phrase that
    starts at each place counts (0 in a closing window)."""
    parts, weights, size = [], [], 0

    def joined():
        data = np.frombuffer(b"".join(parts), "<i4").astype(np.int64)
        return data, np.repeat(np.array([w for w, _ in weights], np.int64), [k for _, k in weights])

    for batch in batches:
        for chunk, closed, n in zip(*[batch.column(c).to_pylist() for c in ("chunk", "closed", "n")]):
            parts += (chunk, b"\0\0\0\0")
            k = len(chunk) // 4
            tail = WINDOW if closed else 0
            weights += ((n, k - tail), (0, tail + 1))
            size += k + 1
        if size > COUNTED:
            yield joined()
            parts, weights, size = [], [], 0
    if parts:
        yield joined()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, n in _sequences(batches):
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (n[:-1] > 0))
        hi = ids[at] << 32 | ids[at + 1]
        yield _summed(hi, np.zeros(len(at), np.int64), n[at])


def _longer_with(sent) -> Callable:
    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if sent is None else np.sort(sent.value)
        for ids, n in _sequences(batches):
            ids = np.concatenate([ids, np.zeros(LONGEST, np.int64)])
            pair = ids[:-1] << 32 | ids[1:]
            good = (ids[:-1] > 0) & (ids[1:] > 0)
            if known is not None:
                place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                good &= known[place] == pair if len(known) else False
            three = np.flatnonzero(good[:-1] & good[1:])
            three = three[n[three] > 0]
            four = three[good[three + 2]]
            hi = np.concatenate([pair[three], pair[four]])
            lo = np.concatenate([ids[three + 2] << 32, ids[four + 2] << 32 | ids[four + 3]])
            if len(hi):
                yield _summed(hi, lo, np.concatenate([n[three], n[four]]))
    return longer


def _in_words(found: DataFrame, words: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``f`` of phrases held as numbers."""
    mask = (1 << 32) - 1
    out = found.withColumns({"i1": F.shiftright("hi", 32), "i2": F.col("hi").bitwiseAND(mask),
                             "i3": F.shiftright("lo", 32), "i4": F.col("lo").bitwiseAND(mask)})
    for k in range(1, LONGEST + 1):
        of = words.select(F.col("id").alias(f"i{k}"), F.col("word").alias(f"w{k}"), *(["lang"] if k == 1 else []))
        out = out.join(of, f"i{k}", "inner" if k < 3 else "left")
    return out.select("lang", F.concat_ws(" ", *[f"w{k}" for k in range(1, LONGEST + 1)]).alias("phrase"), "f")


def phrase_counts(docs: DataFrame, least: int = 30, text: str = "text", lang: str = "lang",
                  most_words: int = MOST_WORDS, most_pairs: int = MOST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """``(frequent, totals)``: ``lang``, ``phrase``, ``f`` of every phrase of one to four
    words that occurs at least ``least`` times, and ``lang``, ``n`` (its words)."""
    python_stage(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, totals = word_counts(rows, least)
    words = stored(_numbered(words), "numbered-words")
    chunks = stored(dictionary(rows, words, most_words), "dictionary")

    def frequent(counted: DataFrame) -> DataFrame:
        return stored(counted.groupBy("hi", "lo").agg(F.sum("n").alias("f")).filter(F.col("f") >= least), "phrases")

    two = frequent(chunks.mapInArrow(_pairs, _schema(PHRASE)))
    sent = None
    if two.count() <= most_pairs:
        keys = two.select("hi").toArrow().column("hi").to_numpy()
        sent = docs.sparkSession.sparkContext.broadcast(np.array(keys, np.int64))
    more = frequent(chunks.mapInArrow(_longer_with(sent), _schema(PHRASE)))
    phrases = _in_words(two.unionByName(more), words)
    return stored(words.select("lang", F.col("word").alias("phrase"), "f").unionByName(phrases), "frequent"), totals


def _n_words(phrase: Column) -> Column:
    return F.size(F.split(phrase, " "))


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """Candidates with their weakest cut: ``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score``.
    Every part of a frequent phrase is frequent, so the joins find all parts."""
    words = F.split("phrase", " ")
    size = F.size(words)
    cuts = (frequent.filter(_n_words(F.col("phrase")) > 1)
            .select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest")))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("(cast(2000000 as decimal(38,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = F.min(F.struct(F.col("score"), F.col("k"), F.col("l"), F.col("r")))
    return (both.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(F.max("a").alias("a"), weakest.alias("m"))
            .select("lang", "phrase", "a", "m.l", "m.r", "m.score"))


def contained(frequent: DataFrame, percent: int = 80) -> DataFrame:
    """Candidates that lie inside a longer candidate at least ``percent`` % as frequent."""
    words = F.split("phrase", " ")
    longer = (frequent.filter(_n_words(F.col("phrase")) > 2).select("lang", words.alias("w"), "f")
              .withColumn("k", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
              .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)))
              .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("k")), " ").alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer_f")))
    both = frequent.join(longer, ["lang", "phrase"])
    return both.filter(_exact(F.col("longer_f")) * 100 >= _exact(F.col("f")) * percent).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, top: int = 2000, text: str = "text",
                 lang: str = "lang", most_words: int = MOST_WORDS, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score``."""
    frequent, totals = phrase_counts(docs, least, text, lang, most_words, most_pairs)
    kept = scored(frequent).join(contained(frequent, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # the row limit is pushed below the shuffle: each task passes on its first rows
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
