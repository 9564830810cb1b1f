"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

``A`` is a byte-level BPE file (tokenizers JSON), ``B`` a sentencepiece model.
Each text is encoded by both as space + text. Byte offsets where tokens of both
end cut the two sequences into groups; tokens whose byte ranges overlap are linked.

Method: lockstep merging. Texts are gathered into blocks of bounded size; every
text of a block is dealt into lanes of ``LANE`` A tokens (a lane's place in B
follows from its first byte), and one NumPy state vector advances the A and B
pointers of all lanes at once. Each step emits one link per live lane, and a cut
where both tokens end; finished lanes are compacted away.

Corpus counts of linked id pairs are summed over blocks (one row per block and
distinct pair, so no pair is a hot key) and return to the blocks, where each
text sums its own links. Nothing is broadcast or collected.

Texts that are null, empty, or whose tokens do not spell space + text byte by
byte (a literal U+2581, say) have no tokens: zeros and empty results. Rows keep
null and repeated ids and stay one to one with the input; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart.llm.common import python_stage, stored

#: A tokens per lane: the number of lockstep rounds a block needs.
LANE = 192
#: Characters of text per block; a longer text is a block of its own.
BLOCK_CHARS = 1_000_000
#: A run this long without a change between blank and not is left to the
#: tokenizer whose time does not grow with its square.
LONG = 600
LONG_BLANK = re.compile(rf"\s{{{LONG}}}")

ALIGNED = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("doc_id", T.LongType()),
    T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()), T.StructField("links", T.BinaryType()),
    T.StructField("pairs", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("a", T.IntegerType()),
        T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])))])


def has_long_run(text: str) -> bool:
    if len(text) < LONG:
        return False
    words = text.split()
    if len(max(words, key=len, default="")) >= LONG:
        return True
    return len(text) - sum(map(len, words)) >= LONG and LONG_BLANK.search(text) is not None


class ByteBpe:
    """Tokenizer A. Where the file's merges are its ids in order, ids alone give
    the merge order and the quicker encoder is exact."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        byte_of = _byte_alphabet()
        vocab = {k: i for k, i in spec["model"]["vocab"].items() if k not in special}
        self.table = [b""] * (max(vocab.values()) + 2)
        for k, i in vocab.items():
            self.table[i] = bytes(byte_of[c] for c in k)
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["model"]["merges"]]
        plain = spec.get("normalizer") is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.quick = None
        if plain and None not in merged and merged == sorted(merged) and len(vocab) == len(merged) + 256:
            # the pattern a byte-level pre-tokenizer splits by (fixed value)
            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.quick = tiktoken.Encoding("a", pat_str=pattern, special_tokens={},
                                           mergeable_ranks={self.table[i]: i for i in vocab.values()})

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.path)
        whole.encode_special_tokens = True
        return whole

    def encode(self, text: str) -> np.ndarray:
        if self.quick is not None and not has_long_run(text):
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)


class PieceBpe:
    """Tokenizer B (it puts the leading space itself)."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = [_piece_bytes(self.model, i) for i in range(self.model.get_piece_size())]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _piece_bytes(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


@functools.lru_cache(maxsize=2)
def _tokenizers(a_file: str, b_file: str):
    a, b = ByteBpe(a_file), PieceBpe(b_file)
    spelling = [pa.array(t.table, pa.large_binary()) for t in (a, b)]
    forms = [{end: np.array([f"{i}{end}" for i in range(len(t.table))], object) for end in ",|;"} for t in (a, b)]
    return a, b, spelling, forms


def _spelled(spelling: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The byte end of each token (after a 0), and the bytes of all tokens in a row."""
    if not len(ids):
        return np.zeros(1, np.int64), b""
    _, ends, data = spelling.take(pa.array(ids)).buffers()
    return np.frombuffer(ends, np.int64, len(ids) + 1), data.to_pybytes() if data else b""


def lockstep(a_ends: np.ndarray, a_from: np.ndarray, b_ends: np.ndarray, b_from: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the token ends of all texts at once. ``a_ends`` and ``b_ends`` hold the
    byte ends of every text's tokens, one text after the other on one common
    byte axis; text t's tokens start at ``a_from[t]`` and ``b_from[t]`` (one entry
    more than texts). Returns the links (A position, B position), in order of the
    steps, and for each link whether it ends a group."""
    lanes = [np.arange(s, e, LANE) for s, e in zip(a_from[:-1], a_from[1:])]
    i = np.concatenate(lanes) if lanes else np.empty(0, np.int64)
    last = np.minimum(i + LANE, np.repeat(a_from[1:], [len(x) for x in lanes]))
    # a lane starts at the B token that covers its first byte
    j = np.searchsorted(b_ends, np.where(i > 0, a_ends[i - 1], 0), side="right")
    links_a, links_b, cuts = [], [], []
    while len(i):
        x, y = a_ends[i], b_ends[j]
        links_a.append(i)
        links_b.append(j)
        cuts.append(x == y)
        i, j = i + (x <= y), j + (y <= x)
        live = i < last
        if not live.all():
            i, j, last = i[live], j[live], last[live]
    if not links_a:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


def _group_text(a_ids, b_ids, a_group, b_group, forms) -> str:
    """``a1,a2|b1;a3|b2``: the groups of one text, ids in order."""
    n_a, n_b = len(a_ids), len(b_ids)
    if not n_a:
        return ""
    out = np.empty(n_a + n_b, object)
    last_a = np.append(a_group[1:] != a_group[:-1], True)
    last_b = np.append(b_group[1:] != b_group[:-1], True)
    at_a = np.arange(n_a) + np.searchsorted(b_group, a_group, side="left")
    at_b = np.arange(n_b) + np.searchsorted(a_group, b_group, side="right")
    out[at_a] = np.where(last_a, forms[0]["|"][a_ids], forms[0][","][a_ids])
    out[at_b] = np.where(last_b, forms[1][";"][b_ids], forms[1][","][b_ids])
    return "".join(out.tolist())[:-1]


def pack(positions: np.ndarray) -> bytes:
    """Whole numbers below 2^32 as compressed bytes, the low bytes first."""
    return zlib.compress(np.ascontiguousarray(positions.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def align_texts(texts: list[str | None], a_file: str, b_file: str) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Align one block. Returns a row per text (``links``: packed positions in the
    block's pairs) and the block's distinct id pairs with their link counts."""
    a, b, spelling, forms = _tokenizers(a_file, b_file)
    whole = [t or "" for t in texts]
    none = np.empty(0, np.int64)
    found = [[a.encode(" " + t) if t else none for t in whole], [b.encode(t) if t else none for t in whole]]
    texts_bytes = [(" " + t).encode() if t else b"" for t in whole]
    same = np.ones(len(whole), bool)
    for spell, ids in zip(spelling, found):
        ends, data = _spelled(spell, np.concatenate([none, *ids]))
        at = ends[np.append(0, np.cumsum([len(x) for x in ids], dtype=np.int64))]
        same &= [data[s:e] == t for s, e, t in zip(at[:-1], at[1:], texts_bytes)]
    a_all, b_all = ([x if ok else none for x, ok in zip(ids, same)] for ids in found)
    a_ids, b_ids = np.concatenate([none, *a_all]), np.concatenate([none, *b_all])
    n_a, n_b = np.array([len(x) for x in a_all], np.int64), np.array([len(x) for x in b_all], np.int64)
    a_from, b_from = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
    n_ids_b = len(spelling[1])
    link_a, link_b, cut = lockstep(_spelled(spelling[0], a_ids)[0][1:], a_from, _spelled(spelling[1], b_ids)[0][1:], b_from)

    a_cut, b_cut = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_cut[link_a[cut]] = 1
    b_cut[link_b[cut]] = 1
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    key = a_ids[link_a] * n_ids_b + b_ids[link_b]
    pair, pos, n = np.unique(key, return_inverse=True, return_counts=True)
    often = np.argsort(-n, kind="stable")  # frequent pairs first: small positions pack well
    place = np.empty_like(often)
    place[often] = np.arange(len(often))
    pair, pos, n = pair[often], place[pos], n[often]
    # the smallest number type that holds the texts' numbers sorts quickest
    doc = (np.searchsorted(a_from, link_a, side="right") - 1).astype(np.min_scalar_type(len(whole)))
    order = np.argsort(doc, kind="stable")
    ends = np.searchsorted(doc[order], np.arange(len(whole) + 1))
    pos = pos[order]
    rows = []
    for k in range(len(whole)):
        s, e, u, v = a_from[k], a_from[k + 1], b_from[k], b_from[k + 1]
        rows.append((int(n_a[k]), int(n_b[k]), int(a_cut[s:e].sum()), int(ends[k + 1] - ends[k]),
                     _group_text(a_ids[s:e], b_ids[u:v], a_group[s:e], b_group[u:v], forms),
                     pack(pos[ends[k]:ends[k + 1]])))
    docs = pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "n_links", "groups", "links"])
    pairs = pd.DataFrame({"pos": np.arange(len(pair), dtype=np.int32), "a": (pair // n_ids_b).astype(np.int32),
                          "b": (pair % n_ids_b).astype(np.int32), "n": n.astype(np.int64)})
    return docs, pairs


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and size + len(t or "") > block_chars:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or "") + 64
    if texts:
        yield ids, texts


def _align_partition(batches: Iterator[pa.RecordBatch], a_file: str, b_file: str,
                     block_chars: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([("block", pa.string()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
                        ("links", pa.binary()), ("pairs", pa.list_(pa.struct([
                            ("pos", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])))])
    part = TaskContext.get().partitionId()
    for k, (ids, texts) in enumerate(_blocks(batches, block_chars)):
        docs, pairs = align_texts(texts, a_file, b_file)
        name = f"{part}-{k}"
        cells = pa.StructArray.from_arrays([pa.array(pairs[c]) for c in ("pos", "a", "b", "n")], ["pos", "a", "b", "n"])
        # the block's pairs ride on its first row, in one list
        held = pa.ListArray.from_arrays(pa.array([0] + [len(pairs)] * len(ids), pa.int32()), cells)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(ids)), pa.array(ids, pa.int64()), *[pa.array(docs[c], pa.int64()) for c in
             ("n_a", "n_b", "n_groups", "n_links")], pa.array(docs["groups"], pa.string()),
             pa.array(docs["links"], pa.binary()), held], schema=schema)


def align(docs: DataFrame, a_file: str, b_file: str, text: str = "text", doc_id: str = "doc_id",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``block``, ``doc_id``, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups`` (``a1,a2|b1;a3|b2,b3``), ``links`` (packed positions in the
    block's pairs) and, on one row of each block, ``pairs`` (its distinct id pairs with link
    counts). Store it before counting: blocks are formed once."""
    python_stage(docs.sparkSession)
    run = functools.partial(_align_partition, a_file=a_file, b_file=b_file, block_chars=block_chars)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ALIGNED)


def block_pairs(aligned: DataFrame) -> DataFrame:
    """``block``, ``pos``, ``a``, ``b``, ``n``: the distinct linked id pairs of each block."""
    return aligned.select("block", F.inline("pairs"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (links of the pair in all documents) and ``best`` (no A id
    is linked more often with this B id)."""
    total = block_pairs(aligned).groupBy("a", "b").agg(F.sum("n").alias("count"))
    return total.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _sum_links(key, docs: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    pairs = pairs.sort_values("pos")
    count, best = pairs["count"].to_numpy(np.int64), pairs["best"].to_numpy(np.int64)
    at = [unpack(x) for x in docs["links"]]
    return docs.drop(columns=["block", "links"]).assign(
        n_best=[int(best[x].sum()) for x in at], count_sum=[int(count[x].sum()) for x in at])


def with_link_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The aligned rows with ``n_best`` and ``count_sum``. Counts go back to blocks,
    one row per block and pair; a block's rows and counts are bounded by its text."""
    back = block_pairs(aligned).join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "pos", "count", "best")
    rows = aligned.drop("pairs")
    out = T.StructType([f for f in rows.schema.fields if f.name not in ("block", "links")]
                       + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    empty = F.col("n_links") == 0  # their block may hold no pair at all
    summed = (rows.filter(~empty).groupBy("block").cogroup(back.groupBy("of_block")).applyInPandas(_sum_links, out))
    zero = rows.filter(empty).drop("block", "links").withColumns(
        {"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    return summed.unionByName(zero)


def link_statistics(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Alignment and corpus counts in one: per document ``doc_id``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise(F.lit(""))
    aligned = stored(align(docs, a_file, b_file).withColumn("groups_sha256", digest).drop("groups"), "aligned")
    counts = stored(pair_counts(aligned), "pair-counts")
    return with_link_counts(aligned, counts)
