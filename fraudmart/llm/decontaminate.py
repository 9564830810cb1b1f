"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Texts and benchmark items become words (lower case, letters and digits). A
mask such as ``11010111`` hashes the words at its 1-positions and ignores the
others. Training and benchmark hashes are joined; each hit fixes an alignment
of the item in the text, which is then compared word by word (once for hits that
follow each other). A document is
contaminated by an item when some ``window`` aligned words hold at most
``substitutions`` differences. The two masks together have a hit in every such
window (for 13 words and any 2 differences), so the result does not depend on
which words were substituted.

Items shorter than the window must occur whole, with the same share of
differences rounded down; those are found by all their one-word-gap masks, that
is by hashing each half. Items below ``shortest`` words are no evidence of
copying and are never reported.

Hashes are made and looked
up inside one generated stage: only hits leave it, so nothing of the texts is
shuffled and no group of a common passage is gathered. A block of the benchmark
holds at most about ``BLOCK_WORDS`` words. What is broadcast of it has a fixed
size per hash and each item's words once, and the blocks run one after the
other, which bounds the memory whatever the size of the benchmark. A benchmark
of several blocks would have the texts hashed for each; so they are first looked
up in a sieve, bits of fixed size set for the hashes of all blocks, and the
blocks only read texts with a hash in it, among them every text with a hit.

Null text or item: no words, no hits. Null ids and repeated rows are reported
like others; one row stands for all rows of the same (doc_id, item_id). Other
columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import stored

#: Every 13-word window with 2 differences holds one of these in some place.
MASKS = ("11010111", "11110000011")
BLOCK_WORDS = 1 << 20
#: Rows of a sieve, and numbers of 64 bits in a row: 32 MB of bits.
SIEVE_ROWS, SIEVE_WIDTH = 1 << 18, 1 << 4


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _seed(words: Column, at: Column, size: Column, mask: str) -> Column:
    """Hash of the mask's words from position ``at`` (from 0); null where the
    mask does not fit."""
    picks = [F.get(words, at + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(at + len(mask) <= size, F.xxhash64(F.lit(mask), *picks))


def _seeds(rows: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """One row per position and mask of ``rows(words, n, ...)``."""
    at, least = F.col("at"), min(map(len, masks))
    # no filter on n here: it would be pushed down and split every text twice
    places = F.when(F.col("n") >= least, F.sequence(F.lit(0), F.col("n") - least)).otherwise(
        F.array().cast("array<int>"))
    return (rows.withColumn("at", F.explode(places))
            .withColumn("seed", F.explode(F.array(*[_seed(F.col("words"), at, F.col("n"), m) for m in masks])))
            .filter("seed is not null"))


def _item_masks(n: int, window: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """Masks that together hit an item of ``n`` words: below the window the two
    halves, one of which is whole if one word differs."""
    return masks if n >= window else tuple(sorted({"1" * (n // 2), "1" * (n - n // 2)}))


def _sieve_place(key: Column) -> tuple[Column, Column, Column]:
    """Row, position in the row and bits of a hash: 18, 4 and five times 6 of its own bits."""
    part = lambda at, size: F.shiftrightunsigned(key, at).bitwiseAND(F.lit(size - 1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), part(at, 64).cast("int")) for at in range(22, 52, 6)]
    return part(0, SIEVE_ROWS), part(18, SIEVE_WIDTH).cast("int"), reduce(Column.bitwiseOR, bits)


def _sieve(hashes: DataFrame) -> DataFrame:
    """The bits of a column of hashes, ``row, bits``; rows without bits are left out."""
    row, at, bits = _sieve_place(F.col(hashes.columns[0]))
    own = [F.coalesce(F.bit_or(F.when(at == k, bits)), F.lit(0).cast("long")) for k in range(SIEVE_WIDTH)]
    return hashes.groupBy(row.alias("row")).agg(F.array(*own).alias("bits"))


def _passed(rows: DataFrame, key: str, sieve: DataFrame) -> DataFrame:
    """The rows whose hash ``key`` has all its bits in the sieve: those whose
    hash went into it, and few others."""
    row, at, bits = _sieve_place(F.col(key))
    return (rows.withColumn("row", row).join(F.broadcast(sieve), "row")
            .filter(F.get("bits", at).bitwiseAND(bits) == bits).drop("row", "bits"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.withColumn("words", plain_words(F.col("text"))).drop("text").withColumn("n", F.size("words"))


def _likely(docs: DataFrame, seeds: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The rows of ``docs(doc_id, text)`` with a hash among ``seeds``, and very few others."""
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    places = _passed(_seeds(_texts(keyed), masks), "seed", _sieve(seeds.select("seed")))
    places = stored(places.select("key", "seed", F.xxhash64("seed").alias("again")), "likely-places")
    # long texts pass the first sieve by chance; one of the hashes that were met holds far fewer
    met = places.select("seed").distinct().join(seeds.select("seed").distinct(), "seed")
    places = _passed(places, "again", _sieve(met.select(F.xxhash64("seed"))))
    left = _passed(keyed, "key", _sieve(stored(places.select("key").distinct(), "likely-keys")))
    return stored(left.select("doc_id", "text"), "likely-texts")


def overlaps(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
             substitutions: int = 2, shortest: int = 8, masks: tuple[str, ...] = MASKS,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_equal``: the best alignment
    of each contaminating item; ``n_equal`` counts equal words of the whole
    item on it, the starts are word positions from 0."""
    items = stored(
        benchmark.select(F.col(item_col).alias("item_id"), plain_words(F.col(item_text_col)).alias("words"))
        .withColumn("n", F.size("words")).filter(F.col("n") >= shortest).distinct()
        .withColumn("item", F.monotonically_increasing_id()), "benchmark-items")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    lengths = sorted(r[0] for r in items.select(F.least("n", F.lit(window))).distinct().collect()) or [window]
    by_length = {n: _item_masks(n, window, masks) for n in lengths}

    every = tuple(sorted({m for own in by_length.values() for m in own}))

    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if blocks > 1:
        docs = _likely(docs, _item_seeds(items, by_length, window), every)
    found = []
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        hits = _aligned(_seeds(_texts(docs), every), own, by_length, window, substitutions)
        # blocks run one after the other, so that one at a time is in memory
        found.append(stored(hits, "overlaps") if blocks > 1 else hits)
    best = F.max(F.struct("n_equal", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i")))
    return (reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", (-F.col("b.d")).alias("doc_start"),
                    (-F.col("b.i")).alias("item_start"), F.col("b.n_equal").alias("n_equal")))


def _item_seeds(items: DataFrame, by_length: dict[int, tuple[str, ...]], window: int) -> DataFrame:
    """``by_length``: the masks of the items of each length, the window standing
    for all lengths from there on."""
    length = F.least("n", F.lit(window))
    return reduce(DataFrame.unionByName, [_seeds(items.filter(length == n), m) for n, m in by_length.items()])


def _hit_before(mask: str) -> Column:
    """Whether the alignment of a hit also has a hit one word earlier."""
    at, item_at = F.col("at") - 1, F.col("item_at") - 1
    fits = (at >= 0) & (item_at >= 0) & (at + len(mask) <= F.col("n")) & (item_at + len(mask) <= F.col("size"))
    return reduce(Column.__and__, [F.get("words", at + k) == F.get("item_words", item_at + k)
                                   for k, c in enumerate(mask) if c == "1"], fits)


def _aligned(places: DataFrame, items: DataFrame, by_length: dict[int, tuple[str, ...]], window: int,
             substitutions: int) -> DataFrame:
    """The alignments that hold, at least once each, from the texts' ``places``."""
    # what is broadcast has a fixed size per seed, and each item's words once
    seeds = _item_seeds(items, by_length, window).select("seed", F.col("at").alias("item_at"), "item")
    whole = items.select("item", "item_id", F.col("words").alias("item_words"), F.col("n").alias("size"))
    hits = places.join(F.broadcast(seeds), "seed").join(F.broadcast(whole), "item")
    # of hits that follow each other on one alignment the first is checked
    own = F.least("size", F.lit(window))
    follows = [(own == n) & _hit_before(m) for n, masks in by_length.items() for m in masks]
    hits = hits.filter(~F.coalesce(reduce(Column.__or__, follows), F.lit(False)))
    # the part of the item that lies inside the text on this alignment
    skip = F.greatest(F.col("item_at") - F.col("at"), F.lit(0))
    start = F.greatest(F.col("at") - F.col("item_at"), F.lit(0))
    room = F.least(F.col("size") - skip, F.col("n") - start)
    same = F.zip_with(F.slice("words", start + 1, room), F.slice("item_words", skip + 1, room),
                      lambda x, y: (x == y).cast("int"))
    # running count of differences d; the latest `own` words hold d[i] - d[i - own]
    allowed = F.floor(own * substitutions / window).cast("int")
    zero = F.struct(F.lit(0).alias("n_equal"), F.lit(window + 1).alias("least"),
                    F.array().cast("array<int>").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        last = F.concat(F.slice(acc["last"], F.greatest(F.size(acc["last"]) - (own - 2), F.lit(1)),
                                own - 1), F.array(x))
        full = F.size(last) == own
        differ = own - F.aggregate(last, F.lit(0), lambda a, y: a + y)
        return F.struct((acc["n_equal"] + x).alias("n_equal"),
                        F.when(full, F.least(acc["least"], differ)).otherwise(acc["least"]).alias("least"),
                        last.alias("last"))

    checked = F.aggregate(same, zero, step)
    verdict = F.filter(F.array(F.struct(start.alias("doc_start"), skip.alias("item_start"),
                                        checked.alias("c"))),
                       lambda v: v["c"]["least"] <= allowed)
    # exploding the verdict keeps the check out of the joins, which stay generated code
    return (hits.select("doc_id", "item_id", F.explode(verdict).alias("v"))
            .select("doc_id", "item_id", "v.doc_start", "v.item_start",
                    F.col("v.c.n_equal").alias("n_equal")))
