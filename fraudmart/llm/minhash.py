"""Near-duplicate documents: MinHash signatures by universal hashing, banding,
signature check, confirmation on full shingle sets, and connected components.

The stages, all on Spark:

1. One pass over the texts gives each document the size and a 128-bit digest
   of its shingle set, one byte of each of many universal hash minima (the
   signature) and one key per band of minima. Documents with equal digests have
   equal sets; they form one class whose smallest id stands for it, so copies
   are never paired.
2. The smallest class of each band bucket is its hub. Each class is compared
   with the hub it shares most buckets with: first signatures, then full sets.
   Confirmed links are closed to components.
3. Buckets that still hold several components are searched completely: classes
   of different components are compared by a long signature (1024 minima, two
   bits each), block by block (a bucket of any size is cut into blocks, and each
   pair of blocks is one piece of work), each pair in the first bucket it shares.
   Survivors are confirmed on full sets. A link inside a component changes
   nothing, so no link between different texts is lost.
4. Components of both sets of links; members get the smallest doc_id.

The band count is chosen so that a pair at the threshold shares no band with
probability below ``miss``; the signature bounds lie five (short) and four and a
half (long) standard deviations under the threshold.

Null text, no words: empty set, linked with nothing. Null doc_id: reported
with its size, component null, kept. Rows that repeat a doc_id count as one
document with several texts. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.llm.common import python_stage, stored
from fraudmart.llm.components import components

U64 = np.uint64
MEMO_WORDS = 300_000
BLOCK = 512
CHUNK = 1 << 16
LONG_HASHES = 1024
#: Ids of texts to fetch again are broadcast up to this number; beyond it the
#: texts are joined by a shuffle.
MAX_BROADCAST_IDS = 4_000_000
#: Equal two-bit fields of two bytes, by their exclusive or.
SAME_FIELDS = np.array([sum((x >> i) & 3 == 0 for i in (0, 2, 4, 6)) for x in range(256)], np.uint8)


def bands_for(percent: int, num_hashes: int, miss: float = 1e-6) -> int:
    """Rows per band: the most that still miss a pair at the threshold with
    probability below ``miss``."""
    s = percent / 100
    fit = [r for r in range(1, num_hashes + 1) if (1 - s**r) ** (num_hashes // r) <= miss]
    return max(fit, default=1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of the word shingles of a text. Words are
    runs of anything but ASCII white space, with A-Z lowered."""

    def __init__(self, width: int):
        self.width, self.memo = width, _WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, U64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        h = np.fromiter(map(self.memo.__getitem__, words), U64, len(words))
        k = min(self.width, len(words))
        acc = np.full(len(words) - k + 1, k, U64)
        for j in range(k):
            acc = _mix(acc * U64(0x9E3779B97F4A7C15) + h[j:len(words) - k + 1 + j])
        return np.unique(acc)


def universal(num_hashes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends; more hashes extend the same sequence."""
    ab = np.random.default_rng(seed).integers(0, 1 << 63, (num_hashes, 2), dtype=U64)
    return ab[:, 0] * U64(2) + U64(1), ab[:, 1]


def minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row of 32-bit minima per (non-empty) set."""
    out = np.empty((len(sets), len(a)), np.uint32)
    lo = 0
    while lo < len(sets):
        hi, n = lo, 0
        while hi < len(sets) and (hi == lo or n + len(sets[hi]) <= CHUNK):
            n += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0] + [len(s) for s in sets[lo:hi - 1]])
        buf = np.empty_like(x)
        for i in range(len(a)):
            np.multiply(x, a[i], out=buf)
            np.add(buf, b[i], out=buf)
            out[lo:hi, i] = np.minimum.reduceat(buf, starts) >> U64(32)
        lo = hi
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    bands = sig.shape[1] // rows
    keys = np.empty((len(sig), bands), U64)
    for j in range(bands):
        acc = np.full(len(sig), j + 1, U64)
        for c in range(j * rows, (j + 1) * rows):
            acc = _mix(acc * U64(0x9E3779B97F4A7C15) + sig[:, c].astype(U64))
        keys[:, j] = acc
    return keys.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], width: int, num_hashes: int, rows: int,
                seed: int) -> Iterator[pa.RecordBatch]:
    shingle, (a, b) = Shingler(width), universal(num_hashes, seed)
    for batch in batches:
        sets = [shingle(t) for t in batch.column(1).to_pylist()]
        full = [s for s in sets if len(s)]
        sig = minima(full, a, b) if full else np.empty((0, num_hashes), np.uint32)
        keys = band_keys(sig, rows)
        at = iter(range(len(full)))
        pick = [next(at) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([
            batch.column(0),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            pa.array([None if i is None else sig[i].astype(np.uint8).tobytes() for i in pick], pa.binary()),
            pa.array([None if i is None else keys[i] for i in pick], pa.list_(pa.int64())),
        ], names=["doc_id", "n_shingles", "digest", "sig", "bands"])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    shingle = Shingler(width)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingle(t).tobytes() for t in batch.column(1).to_pylist()],
                                       pa.binary())], names=["node", "grams"])


def _details(batches: Iterator[pa.RecordBatch], width: int, num_hashes: int, rows: int,
             seed: int) -> Iterator[pa.RecordBatch]:
    """Band keys and long signatures of the texts."""
    shingle, (a, b) = Shingler(width), universal(LONG_HASHES, seed)
    for batch in batches:
        kept = [(i, x) for i, x in zip(batch.column(0).to_pylist(), map(shingle, batch.column(1).to_pylist())) if len(x)]
        if not kept:
            continue
        sig = minima([x for _, x in kept], a, b)
        two = (sig & 3).astype(np.uint8).reshape(len(sig), -1, 4)
        packed = two[:, :, 0] | two[:, :, 1] << 2 | two[:, :, 2] << 4 | two[:, :, 3] << 6
        keys = band_keys(sig[:, :num_hashes], rows)
        yield pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in kept], pa.int64()), pa.array([len(x) for _, x in kept], pa.int64()),
            pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([p.tobytes() for p in packed], pa.binary())],
            names=["node", "n", "keys", "long_sig"])


@F.pandas_udf(T.IntegerType())
def _equal_minima(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([int((np.frombuffer(p, np.uint8) == np.frombuffer(q, np.uint8)).sum())
                      for p, q in zip(x, y)], dtype="int32")


@F.pandas_udf(T.LongType())
def _common(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(np.frombuffer(p, U64), np.frombuffer(q, U64), assume_unique=True))
                      for p, q in zip(x, y)], dtype="int64")


def _block_pairs(batches: Iterator[pa.RecordBatch], percent: int, least: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (key, i, j): each run is one pair of blocks of one
    bucket (side 0 and side 1; a block with itself has side 2 only). Only pairs
    whose first shared band is this bucket are looked at."""

    def compare(key: int, rows: list[tuple]) -> tuple[list[int], list[int]]:
        node, comp, side, size = (np.array([r[c] for r in rows]) for c in range(4))
        bands = np.frombuffer(b"".join(r[4] for r in rows), np.int64).reshape(len(rows), -1)
        sig = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        here = (bands == key).argmax(axis=1)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        xs, ys = [], []
        for p in left:
            q = right[(comp[right] != comp[p])
                      & (100 * np.minimum(size[right], size[p]) >= percent * np.maximum(size[right], size[p]))]
            if side[p] == 2:
                q = q[node[q] > node[p]]
            if len(q) and here[p]:
                q = q[~(bands[q, :here[p]] == bands[p, :here[p]]).any(axis=1)]
            if len(q):
                q = q[SAME_FIELDS[sig[q] ^ sig[p]].sum(axis=1, dtype=np.int64) >= least]
                xs += [int(node[p])] * len(q)
                ys += node[q].tolist()
        return xs, ys

    def flush(key, rows):
        xs, ys = compare(key, rows)
        return pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], names=["a", "b"])

    at, rows = None, []
    for batch in batches:
        for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, i, j) != at:
                if len(rows) > 1:
                    yield flush(at[0], rows)
                at, rows = (key, i, j), []
            rows.append(row)
    if len(rows) > 1:
        yield flush(at[0], rows)


SIGNED = "doc_id long, n_shingles long, digest binary, sig binary, bands array<long>"


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int,
               percent: int, num_hashes: int = 128, seed: int = 7) -> DataFrame:
    """One row per document: set size, digest of the set, signature, band keys."""
    python_stage(docs.sparkSession)
    rows = bands_for(percent, num_hashes)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_signatures, width=width, num_hashes=num_hashes, rows=rows, seed=seed), SIGNED)


def _texts_of(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame) -> DataFrame:
    """``node, text`` of the documents whose ids are in ``nodes(node)``."""
    if nodes.count() <= MAX_BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    return (docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
            .join(nodes, "node", "left_semi"))


def _confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
             percent: int, name: str) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    pairs = stored(pairs, f"{name}-candidates")
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}-ids")
    sets = stored(_texts_of(docs, id_col, text_col, wanted)
                  .mapInArrow(partial(_sets, width=width), "node long, grams binary"), f"{name}-sets")
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    both = (pairs.join(left, "a").join(right, "b")
            .select("a", "b", F.length("ga").alias("la"), F.length("gb").alias("lb"), _common("ga", "gb").alias("i")))
    return stored(both.filter(100 * F.col("i") >= percent * ((F.col("la") + F.col("lb")) / 8 - F.col("i")))
                  .select("a", "b").distinct(), f"{name}-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5,
                    percent: int = 80, num_hashes: int = 128, seed: int = 7) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    signed = stored(signatures(docs, id_col, text_col, width=width, percent=percent,
                               num_hashes=num_hashes, seed=seed), "signatures")
    s, rows = percent / 100, bands_for(percent, num_hashes)
    named = signed.filter("digest is not null and doc_id is not null")
    classes = stored(named.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands")), "classes")
    keyed = classes.select("node", F.explode("bands").alias("key"))

    # 2. each class against the hub it shares most buckets with
    hubs = (keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
            .filter("hub < top").drop("top"))
    shared = stored(keyed.join(hubs, "key"), "shared-buckets")
    stars = (shared.filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("c"))
             .groupBy("node").agg(F.max(F.struct("c", (-F.col("hub")).alias("h"))).alias("best"))
             .select(F.col("node").alias("a"), (-F.col("best.h")).alias("b")))
    sig_a = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    sig_b = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    least = max(1, int(num_hashes * (s - 5 * (s * (1 - s) / num_hashes) ** 0.5)))
    near = (stars.join(sig_a, "a").join(sig_b, "b")
            .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .filter(_equal_minima("sa", "sb") >= least).select("a", "b"))
    links = _confirm(near, docs, id_col, text_col, width, percent, "star")
    first = components(links)

    # 3. buckets that still hold several components
    spots = stored(shared.select("key", "node").join(first.withColumnRenamed("component", "comp"), "node", "left")
                   .withColumn("comp", F.coalesce("comp", "node")), "bucket-components")
    open_keys = (spots.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                          F.count("*").alias("m")).filter("lo < hi")
                 .select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    member = stored(spots.join(open_keys, "key"), "open-buckets")
    open_nodes = stored(member.select("node").distinct(), "open-ids")
    detail = _texts_of(docs, id_col, text_col, open_nodes).mapInArrow(
        partial(_details, width=width, num_hashes=num_hashes, rows=rows, seed=seed),
        "node long, n long, keys binary, long_sig binary")
    placed = (member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      "node", "comp", F.when(F.col("block") == F.col("other"), 2)
                      .when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")))
    match = s + (1 - s) / 4  # two bits agree by chance in a quarter of the others
    bound = int(LONG_HASHES * (match - 4.5 * (match * (1 - match) / LONG_HASHES) ** 0.5))
    found = (placed.join(detail, "node").select("key", "i", "j", "node", "comp", "side", "n", "keys", "long_sig")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(partial(_block_pairs, percent=percent, least=bound), "a long, b long").distinct())
    more = _confirm(found, docs, id_col, text_col, width, percent, "cross")

    # 4. an id that repeats is one document: its texts' classes belong together
    again = stored(signed.filter("doc_id is not null").groupBy("doc_id")
                   .agg(F.count_distinct(F.coalesce("digest", F.lit(b""))).alias("n")).filter("n > 1").select("doc_id"),
                   "repeated-ids")
    own = (named.select("doc_id", "digest").join(again, "doc_id").distinct().join(classes.select("digest", "node"), "digest")
           .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))

    # 5. members of each class and component
    groups = components(links.union(more).union(own))
    rep = classes.select("digest", "node").join(groups, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    # a text without words belongs to the other texts of its id
    rest = again.join(groups, again["doc_id"] == groups["node"]).select(
        "doc_id", F.col("component").alias("of_id"))
    full = signed.filter("digest is not null").select("doc_id", "n_shingles", "digest").join(rep, "digest", "left")
    blank = (signed.filter("digest is null").select("doc_id", "n_shingles", "digest").join(rest, "doc_id", "left")
             .select("digest", "doc_id", "n_shingles", F.col("of_id").alias("component")))
    joined = full.unionByName(blank)
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(
        F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
