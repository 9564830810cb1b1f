"""Language identification as a mixture: the language proportions of a text by
expectation-maximisation over n-gram likelihoods.

Training counts hashed character n-grams (1 to 4 characters of lower-case
letters, words padded with blanks) per language and keeps smoothed
log-likelihoods. A text's n-grams are draws from a mixture of the languages:
EM gives the proportions; languages are added in order of proportion, and the
set with the highest penalised likelihood stays. The prediction is the language
with the largest share of that set, the score is its share.

Training takes at most about ``docs_per_lang`` documents of a language (a
documented bound for fitting the classifier): rows whose hashed id lies under
the ratio of that bound to the language's count. The model is one table of
languages by hash bins; bins are chosen so that it never exceeds
``model_bytes``, whatever the number of languages, and only that is broadcast.

Null text or no letter: ``und``, score 0. With no training rows every text is
``und``. Null lang rows do not train. Null ids, repeated rows: predicted like
others; training treats a null id as an id of its own. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import python_stage, spread, stored

UNKNOWN = "und"
DOCS_PER_LANG = 1500
MODEL_BYTES = 16 << 20
MAX_BITS = 16
ORDERS = (1, 2, 3, 4)
#: Adjacent n-grams share letters, so the penalty counts each as less than one draw.
PENALTY = 8.0
ROUNDS = 40
SMOOTHING = 0.5


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Hash bins of all n-grams of a text."""

    def __init__(self, bits: int):
        self.bits, self.letters = bits, _letter_table()

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int64)
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        word = self.letters[code]
        if not word.any():
            return np.empty(0, np.int64)
        # runs of other characters become one blank; one blank at either end
        c = np.where(word, code, 32).astype(np.uint32)
        c = c[word | np.concatenate([[False], word[:-1]])]
        c = np.concatenate([[32], c, [32]] if c[-1] != 32 else [[32], c]).astype(np.uint32)
        out, acc = [], np.zeros(len(c), np.uint32)
        for n in ORDERS:
            m = len(c) - n + 1
            if m <= 0:
                break
            acc = acc[:m] * np.uint32(0x01000193) + c[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
            out.append((acc ^ (acc >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - self.bits))
        return np.concatenate(out).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    grams, total = Grams(bits), {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if lang not in total:
                total[lang] = np.zeros(1 << bits, np.int64)
            total[lang] += np.bincount(grams(text), minlength=1 << bits)
    for lang, n in total.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                          pa.array(n[at], pa.int64())], names=["lang", "bin", "n"])


def fit(docs: DataFrame, may_train: Column, *, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG, model_bytes: int = MODEL_BYTES
        ) -> tuple[list[str], np.ndarray, int]:
    """(languages, log-likelihoods by language and bin, bits)."""
    python_stage(docs.sparkSession)
    rows = (docs.filter(may_train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("docs")), "lang-counts")
    n_langs = counts.count()
    if not n_langs:
        return [], np.empty((0, 1)), 0
    bits = min(MAX_BITS, int(np.log2(model_bytes / (4 * n_langs))))
    if bits < 8:
        raise ValueError(f"{n_langs} languages do not fit a model of {model_bytes} bytes")
    sample = (rows.join(F.broadcast(counts), "lang")
              .filter(spread("language-sample", "id") * F.col("docs") < docs_per_lang).select("text", "lang"))
    table = (sample.mapInArrow(partial(_count, bits=bits), "lang string, bin int, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    # at most languages x bins rows, bounded by model_bytes
    pdf = table.toPandas()
    langs = sorted(r["lang"] for r in counts.select("lang").collect())
    n = np.zeros((len(langs), 1 << bits))
    n[pdf["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(np.int64), pdf["bin"].to_numpy()] = pdf["n"]
    n += SMOOTHING
    return langs, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32), bits


def likelihoods(logs: np.ndarray) -> np.ndarray:
    """Per bin, the languages' likelihoods relative to the bin's largest (a
    common factor of a draw changes neither weights nor comparisons)."""
    return np.ascontiguousarray(np.exp((logs - logs.max(axis=0)).astype(np.float64)).T)


def proportions(p: np.ndarray, rounds: int = ROUNDS, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """EM for the mixture weights of likelihoods ``p`` (draws by languages; a
    row stands for ``times`` equal draws); the weights and the log-likelihood."""
    k = p.shape[1]
    times = np.ones(len(p)) if times is None else times
    n, rows = times.sum(), np.ascontiguousarray(p.T)
    w = np.full(k, 1 / k)
    if k > 1:
        for _ in range(rounds):
            new = w * (rows @ (times / (w @ rows))) / n
            done = np.abs(new - w).max() < 1e-3
            w = new
            if done:
                break
    return w, float(times @ np.log(w @ rows))


def infer(p: np.ndarray, penalty: float = PENALTY, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(language numbers, shares), largest share first, of one text's draws
    (a row of ``p`` stands for ``times`` equal draws)."""
    n = len(p) if times is None else times.sum()
    w, _ = proportions(p, times=times)
    order = np.argsort(-w, kind="stable")
    best, keep, share = -np.inf, order[:1], np.ones(1)
    for k in range(1, len(order) + 1):
        if w[order[k - 1]] < 0.01:
            break
        if k == 1 and (len(order) == 1 or w[order[1]] < 0.01):
            break  # no second language to compare with
        sub, ll = proportions(p[:, order[:k]], times=times)
        value = ll - penalty * (k - 1) * np.log(n)
        if value <= best:
            break
        best, keep, share = value, order[:k], sub
    at = np.argsort(-share, kind="stable")
    return keep[at], share[at]


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    langs, logs, bits = model.value
    grams, table = Grams(bits), likelihoods(logs) if langs else None
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            at = grams(text)
            if not len(at) or not langs:
                rows.append((UNKNOWN, 0.0, [], []))
                continue
            # a text repeats its short n-grams: each bin once, with how often it is drawn
            times = np.bincount(at)
            bins = np.flatnonzero(times)
            keep, share = infer(table[bins], times=times[bins].astype(np.float64))
            rows.append((langs[keep[0]], float(share[0]), [langs[i] for i in keep], share.tolist()))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
            pa.array([r[2] for r in rows], pa.list_(pa.string())),
            pa.array([r[3] for r in rows], pa.list_(pa.float64()))],
            names=["doc_id", "lang_pred", "score", "langs", "shares"])


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, int], *, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, langs, shares`` per row: the selected
    languages and their proportions."""
    spark = docs.sparkSession
    python_stage(spark)
    shared = spark.sparkContext.broadcast(model if model[2] else (model[0], model[1], 8))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        partial(_predict, model=shared),
        "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>")
