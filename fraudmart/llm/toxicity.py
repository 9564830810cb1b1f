"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index, distance-weighted votes, calibrated scores with evidence.

Fitting takes a bounded, documented sample of the labelled rows: at most
``examples_per_class`` documents of either label, those with the smallest hashed
ids. Terms are words and character 5-grams of words; the at most ``max_terms``
terms whose document frequencies differ most between the labels form the
vocabulary (two-proportion z with continuity correction at least ``min_z``; common
words with a slight preference count too, many of them are evidence). Every example is a TF-IDF
vector over it, so the model has at most 2 x ``examples_per_class`` x ``max_terms`` weights:
a size bound for the broadcast.

The index keeps the examples in blocks and the largest weight of each term in
each block. A query adds these maxima to bounds of the blocks, reads the blocks
with the highest bounds and then only those that can reach the k-th cosine. The
queries of a batch read a block together, as one single-precision matrix product;
whatever its rounding error leaves in reach of the k-th cosine is computed again in
double precision: the result is the exact top k (ties by smaller doc_id).

A score is the calibrated vote: neighbours vote with cosine squared times the
number of labelled rows an example stands for, plus a small vote of the rate
among examples without any vocabulary term. Votes of the examples themselves
(each left out of its own neighbours) give an isotonic map to probabilities.

All rows are scored over their whole texts. Null or empty text has no term and
no neighbour: its score is the calibrated base rate. Null labels and ids do not
train; a document labelled both ways counts as toxic. If one label has no
example, every score is the label rate (0 without labels). Repeated rows are
scored alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import ARROW_ROWS, python_stage, spread, stored

EXAMPLES_PER_CLASS = 3072
MAX_TERMS = 2048
MIN_Z = 4.5
GRAM = 5
BLOCK = 64
#: Blocks read first to find a k-th cosine.
PROBE = 4
NEIGHBOURS = 15
BASE_VOTE = 0.02
LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The word and its character n-grams (marked, to differ from words)."""
    return [word, *("~" + word[i:i + GRAM] for i in range(len(word) - GRAM + 1))]


def _in_word(c: str) -> bool:
    return c.isalnum() and not c.isdecimal()


class Vectoriser:
    """TF-IDF vectors over the vocabulary. One automaton finds all terms in a
    pass over the text, so nothing is kept between texts."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray):
        self.idf = idf
        found: dict[str, list[int]] = {}  # string -> its number as a word and as an n-gram
        for term, i in vocabulary.items():
            gram = term.startswith("~")
            found.setdefault(term[1:] if gram else term, [-1, -1])[gram] = i
        self.automaton = ahocorasick.Automaton()
        for key, (word, gram) in found.items():
            self.automaton.add_word(key, (len(key), word, gram))
        if found:
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term ids and weights of the unit vector; empty without terms."""
        n: dict[int, int] = {}
        if text and len(self.automaton):
            text = text.lower()
            last = len(text) - 1
            for end, (size, word, gram) in self.automaton.iter(text):
                if gram >= 0:
                    n[gram] = n.get(gram, 0) + 1
                if (word >= 0 and (end == last or not _in_word(text[end + 1]))
                        and (end < size or not _in_word(text[end - size]))):
                    n[word] = n.get(word, 0) + 1
        if not n:
            return np.empty(0, np.int64), np.empty(0)
        ids = np.array(sorted(n), np.int64)
        w = (1 + np.log([n[i] for i in ids.tolist()])) * self.idf[ids]
        return ids, w / np.sqrt(w @ w)


class BlockMaxIndex:
    """Unit vectors with positive weights, in blocks of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n, self.n_terms = len(vectors), n_terms
        self.blocks = -(-self.n // BLOCK)
        self.example = np.repeat(np.arange(self.n, dtype=np.int32), [len(i) for i, _ in vectors])
        self.term = np.concatenate([i for i, _ in vectors]).astype(np.int32) if vectors else np.empty(0, np.int32)
        self.weight = np.concatenate([w for _, w in vectors]).astype(np.float32) if vectors else np.empty(0, np.float32)
        self.max = np.zeros((n_terms, self.blocks), np.float32)
        np.maximum.at(self.max, (self.term, self.example // BLOCK), self.weight)
        #: Bound of the rounding error of a single-precision cosine.
        self.slack = (n_terms + 4) * 2.0 ** -23
        self.rows: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rows": None}  # the postings are smaller to ship

    def _rows(self) -> np.ndarray:
        if self.rows is None:
            self.rows = np.zeros((self.n, self.n_terms), np.float32)
            self.rows[self.example, self.term] = self.weight
        return self.rows

    def _read(self, queries: np.ndarray, wanted: np.ndarray, scores: np.ndarray) -> None:
        """Fill in the scores of the examples of the wanted (query, block)s."""
        rows = self._rows()
        for b in np.flatnonzero(wanted.any(axis=0)).tolist():
            at, own = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
            scores[at, own] = queries[at] @ rows[own].T

    def top_many(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None
                 ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per vector (examples, cosines) of the k best with a positive cosine,
        best first, equal cosines by example number. The blocks with the highest
        bounds give a k-th cosine; only blocks that can reach it are read."""
        found = [(np.empty(0, np.int64), np.empty(0))] * len(vectors)
        live = [v for v, (ids, _) in enumerate(vectors) if len(ids)]
        if not live or not self.n:
            return found
        queries = np.zeros((len(live), self.n_terms), np.float32)
        for q, v in enumerate(live):
            queries[q, vectors[v][0]] = vectors[v][1]
        bound = queries @ self.max
        first = np.argsort(-bound, axis=1, kind="stable")[:, :PROBE]
        wanted = np.zeros(bound.shape, bool)
        np.put_along_axis(wanted, first, True, axis=1)
        wanted &= bound > 0
        scores = np.zeros((len(live), self.n), np.float32)

        def reach() -> np.ndarray:
            """What a score must be at least to be among the k best."""
            if without is not None:
                for q, v in enumerate(live):
                    if without[v] >= 0:
                        scores[q, without[v]] = 0
            if self.n < k:
                return np.zeros((len(live), 1))
            return np.partition(scores, self.n - k, axis=1)[:, self.n - k, None] - 2 * self.slack

        self._read(queries, wanted, scores)
        # a bound is a sum of maxima, larger than one, with the error that goes with it
        self._read(queries, ~wanted & (bound > 0) & (bound * (1 + self.slack) >= reach()), scores)
        near = (scores > 0) & (scores >= reach())
        for q, v in enumerate(live):
            ids, weights = vectors[v]
            e = np.flatnonzero(near[q])
            s = np.round((self._rows()[np.ix_(e, ids)] * weights).sum(axis=1), 12)
            e, s = e[s > 0], s[s > 0]
            keep = np.lexsort((e, -s))[:k]
            found[v] = e[keep], s[keep]
        return found

    def top(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1
            ) -> tuple[np.ndarray, np.ndarray]:
        return self.top_many([(ids, weights)], k, [without])[0]


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    doc_ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    base: float
    steps: np.ndarray | None = None  # votes and probabilities of the calibration
    values: np.ndarray | None = None

    def vote(self, e: np.ndarray, s: np.ndarray) -> float:
        w = self.stands_for[e] * s * s
        prior = BASE_VOTE * (self.stands_for.mean() if len(self.stands_for) else 1.0)
        return float((w @ self.toxic[e] + prior * self.base) / (w.sum() + prior))

    def probability(self, vote: float) -> float:
        if self.steps is None or not len(self.steps):
            return min(max(vote, 0.0), 1.0)
        return float(np.interp(vote, self.steps, self.values))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted pool-adjacent-violators fit: knots and values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # mean, weight, lowest x, highest x
    for xi, yi, wi in zip(x[order], y[order], w[order]):
        pools.append([yi, wi, xi, xi])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            b, a = pools.pop(), pools[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1], a[3] = a[1] + b[1], b[3]
    knots = np.array([[p[2], p[0]] for p in pools] + [[p[3], p[0]] for p in pools])
    knots = knots[np.lexsort((knots[:, 1], knots[:, 0]))] if len(knots) else knots.reshape(0, 2)
    return knots[:, 0], knots[:, 1]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [sorted({t for word in set(LETTERS.findall((x or "").lower())) for t in terms_of(word)})
                for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.string()))],
                                         names=["toxic", "terms"])


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: dict[str, int], idf: np.ndarray
             ) -> Iterator[pa.RecordBatch]:
    vector = Vectoriser(vocabulary, idf)
    for batch in batches:
        got = [vector(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array([i for i, _ in got], pa.list_(pa.int64())),
            pa.array([w for _, w in got], pa.list_(pa.float64()))], names=["doc_id", "toxic", "ids", "weights"])


def fit(docs: DataFrame, labels: DataFrame, may_train: Column, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", examples_per_class: int = EXAMPLES_PER_CLASS, max_terms: int = MAX_TERMS,
        min_z: float = MIN_Z, neighbours: int = NEIGHBOURS) -> Model:
    """``may_train`` is a condition on ``doc_id``."""
    python_stage(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = stored(labels.select(F.col("doc_id").cast("long"), F.col(label_col).cast("int").alias("toxic"))
                    .filter(may_train & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
                    .groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    chosen = [marked.filter(F.col("toxic") == y).orderBy(spread("toxicity-examples", "doc_id"), "doc_id")
              .limit(examples_per_class) for y in (0, 1)]
    ids = stored(chosen[0].unionByName(chosen[1]), "example-ids")
    # a repeated id trains by one of its texts, the first by content
    examples = stored(texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic")
                      .agg(F.min("text").alias("text")), "examples")
    sizes = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    every = totals.get(0, 0) + totals.get(1, 0)
    if not n1 or not n0:
        return Model({}, np.empty(0), BlockMaxIndex([], 0), np.empty(0, np.int64), np.empty(0), np.empty(0),
                     totals.get(1, 0) / every if every else 0.0)

    d1, d0 = F.col("d1"), F.col("d0")
    p = (d1 + d0) / F.lit(float(n1 + n0))
    # with continuity correction, so that a few chance documents are no evidence
    z = ((F.abs(d1 / n1 - d0 / n0) - F.lit(0.5 / n1 + 0.5 / n0))
         / F.sqrt(p * (1 - p) * F.lit(1 / n1 + 1 / n0)))
    counts = (examples.select("toxic", "text").mapInArrow(_features, "toxic int, terms array<string>")
              .select("toxic", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum(F.col("toxic").cast("long")).alias("d1"), F.sum(1 - F.col("toxic")).cast("long").alias("d0")))
    picked = (counts.filter(d1 + d0 < n1 + n0).withColumn("z", z).filter(F.col("z") >= min_z)
              .orderBy(F.desc("z"), "term").limit(max_terms).collect())
    vocabulary = {r["term"]: i for i, r in enumerate(picked)}
    idf = np.log((1 + n1 + n0) / (1 + np.array([r["d1"] + r["d0"] for r in picked], float))) + 1

    rows = (examples.mapInArrow(partial(_vectors, vocabulary=vocabulary, idf=idf),
                                "doc_id long, toxic int, ids array<long>, weights array<double>")
            .orderBy("doc_id").collect())  # at most 2 x examples_per_class rows of max_terms weights
    vectors = [(np.array(r["ids"], np.int64), np.array(r["weights"])) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], float)
    stands = np.where(toxic == 1, totals[1] / n1, totals[0] / n0)
    bare = np.array([not len(i) for i, _ in vectors])
    base = float((stands[bare] @ toxic[bare] + totals[1] / every) / (stands[bare].sum() + 1))
    model = Model(vocabulary, idf, BlockMaxIndex(vectors, len(vocabulary)),
                  np.array([r["doc_id"] for r in rows], np.int64), toxic, stands, base)
    votes = np.array([model.vote(e, s) for at in range(0, len(vectors), ARROW_ROWS) for e, s in model.index.top_many(
        vectors[at:at + ARROW_ROWS], neighbours, list(range(at, min(at + ARROW_ROWS, len(vectors)))))])
    model.steps, model.values = isotonic(votes, toxic, stands)
    return model


def _score(batches: Iterator[pa.RecordBatch], model, neighbours: int) -> Iterator[pa.RecordBatch]:
    m: Model = model.value
    vector = Vectoriser(m.vocabulary, m.idf)
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
    bare = m.probability(m.vote(np.empty(0, np.int64), np.empty(0)))
    for batch in batches:
        scores, found = [], []
        vectors = [vector(text) for text in batch.column(1).to_pylist()]
        for (ids, _), (e, s) in zip(vectors, m.index.top_many(vectors, neighbours)):
            if not len(ids):
                scores.append(bare)
                found.append([])
                continue
            scores.append(m.probability(m.vote(e, s)))
            found.append([{"doc_id": int(m.doc_ids[i]), "cosine": float(c), "toxic": int(m.toxic[i])}
                          for i, c in zip(e[:3], s[:3])])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()),
                                          pa.array(found, evidence)], names=["doc_id", "score", "evidence"])


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
          neighbours: int = NEIGHBOURS) -> DataFrame:
    """``doc_id, score, evidence`` per row; evidence: the nearest three
    examples with cosine and label."""
    spark = docs.sparkSession
    python_stage(spark)
    shared = spark.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_score, model=shared, neighbours=neighbours),
        "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")
