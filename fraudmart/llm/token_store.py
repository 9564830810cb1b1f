"""Token-id files with keyed access through a minimal perfect hash index.

Layout of a store (all below one shared folder):

- ``ids-00012.bin``: the ids of one range of documents, one after another,
  as little-endian unsigned integers, nothing else. Shards follow the
  document keys, so shards in order hold all documents in ascending key order.
- ``index-00003.npz``: the documents whose key hashes to this index shard. A
  minimal perfect hash (levels of bit arrays: a key takes the first level where
  its position is its own; its slot is that bit's rank) maps each distinct key
  to one slot without storing keys; a slot holds a 32-bit fingerprint and the
  (payload shard, offset, length) of the key's rows.
- ``manifest``: a Parquet table of the same places, for scans.

Shards are written by tasks under a temporary name and renamed, so a lost
executor's work is repeated, never mixed. A task holds one Arrow batch of texts
or one index shard (a hashed share of the keys) at a time.

Null text: no ids, the end id only. Rows that repeat a key are stored in the
order of their texts, and a lookup returns all of them. A null key is stored
(before all others) and listed in the manifest, but it cannot be looked up.
An unknown key is absent from a lookup unless its 32-bit fingerprint collides.
Other columns are ignored.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import python_stage
from fraudmart.llm.encoder import Encoder, worker_encoder

U64 = np.uint64
PLACES = "doc_id long, shard int, offset long, n_tokens long"
KEYS_PER_INDEX = 1 << 15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _level(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mix(keys + U64(level * 0x9E3779B97F4A7C15 % (1 << 64))) % U64(size)).astype(np.int64)


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ U64(0xD6E8FEB86659FD93)) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, sizes, left = [], [], keys
        while len(left):
            size = max(8, 2 * len(left))
            at = _level(left, len(sizes), size)
            own = np.bincount(at, minlength=size) == 1
            bits.append(own)
            sizes.append(size)
            left = left[~own[at]]
        return cls(np.concatenate(bits) if bits else np.empty(0, bool), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level takes it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.first[level] + _level(keys[left], level, int(size))
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out


@dataclass(frozen=True)
class TokenStore:
    path: str
    width: int
    index_shards: int

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in uri.split("/")[0]:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _publish(fs: pafs.FileSystem, temporary: str, final: str) -> None:
    fs.move(temporary, final)


def _write_ids(batches: Iterator[pa.RecordBatch], path: str, tokenizer: str, end_id: int | None,
               width: int) -> Iterator[pa.RecordBatch]:
    fs, base = _open(path)
    task = TaskContext.get()
    shard, name = task.partitionId(), f"{base}/ids-{task.partitionId():05d}.bin"
    encode, out, offset = None, None, 0
    temporary = f"{name}.{task.taskAttemptId()}.tmp"
    for batch in batches:
        if encode is None:
            encode, out = worker_encoder(tokenizer, path), fs.open_output_stream(temporary)
        places = []
        for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
            if end_id is not None:
                ids = np.append(ids, ids.dtype.type(end_id))
            out.write(ids.astype(f"<u{width}", copy=False).tobytes())
            places.append((key, offset, len(ids)))
            offset += len(ids)
        yield pa.RecordBatch.from_arrays([
            pa.array([p[0] for p in places], pa.int64()), pa.array([shard] * len(places), pa.int32()),
            pa.array([p[1] for p in places], pa.int64()), pa.array([p[2] for p in places], pa.int64())],
            names=["doc_id", "shard", "offset", "n_tokens"])
    if out is not None:
        out.close()
        _publish(fs, temporary, name)


def _write_index(pdf: pd.DataFrame, path: str) -> pd.DataFrame:
    fs, base = _open(path)
    number = int(pdf["index_shard"].iloc[0])
    keys = pdf["doc_id"].to_numpy(np.int64).view(U64)
    distinct = np.unique(keys)
    table = PerfectHash.build(distinct)
    pdf = pdf.assign(slot=table.slots(keys)).sort_values(["slot", "shard", "offset"])
    prints = np.empty(len(distinct), np.uint32)
    prints[table.slots(distinct)] = _fingerprint(distinct)
    buf = io.BytesIO()
    np.savez(buf, bits=np.packbits(table.bits), sizes=table.sizes, prints=prints,
             first=np.concatenate([[0], np.cumsum(np.bincount(pdf["slot"], minlength=len(distinct)))]),
             shard=pdf["shard"].to_numpy(np.int32), offset=pdf["offset"].to_numpy(np.int64),
             length=pdf["n_tokens"].to_numpy(np.int64))
    name = f"{base}/index-{number:05d}.npz"
    temporary = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
    with fs.open_output_stream(temporary) as out:
        out.write(buf.getvalue())
    _publish(fs, temporary, name)
    return pd.DataFrame({"index_shard": [number], "keys": [len(distinct)]})


def _find(pdf: pd.DataFrame, path: str) -> pd.DataFrame:
    fs, base = _open(path)
    number = int(pdf["index_shard"].iloc[0])
    info = fs.get_file_info(f"{base}/index-{number:05d}.npz")
    keys = np.unique(pdf["doc_id"].to_numpy(np.int64))
    columns = ["doc_id", "shard", "offset", "n_tokens"]
    if info.type == pafs.FileType.NotFound:
        return pd.DataFrame({c: np.empty(0, np.int64) for c in columns})
    with fs.open_input_file(info.path) as f:
        z = np.load(io.BytesIO(f.read()))
    table = PerfectHash(np.unpackbits(z["bits"], count=int(z["sizes"].sum())).astype(bool), z["sizes"])
    slots = table.slots(keys.view(U64))
    known = slots >= 0
    known[known] = z["prints"][slots[known]] == _fingerprint(keys[known].view(U64))
    keys, slots = keys[known], slots[known]
    rows = z["first"][slots + 1] - z["first"][slots]
    at = np.repeat(z["first"][slots] - np.cumsum(rows) + rows, rows) + np.arange(rows.sum())
    return pd.DataFrame({"doc_id": np.repeat(keys, rows), "shard": z["shard"][at],
                         "offset": z["offset"][at], "n_tokens": z["length"][at]})


def _read_ids(batches: Iterator[pa.RecordBatch], path: str, width: int, payload: bool) -> Iterator[pa.RecordBatch]:
    fs, base = _open(path)
    at, file = None, None
    for batch in batches:
        got = []
        for shard, offset, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            if shard != at:
                if file is not None:
                    file.close()
                at, file = shard, fs.open_input_file(f"{base}/ids-{shard:05d}.bin")
            raw = file.read_at(n * width, offset * width)
            got.append(np.frombuffer(raw, f"<u{width}").astype("<u4"))
        if payload:
            last = pa.array([x.astype(np.int64) for x in got], pa.list_(pa.int64()))
        else:
            last = pa.array([zlib.crc32(x.tobytes()) for x in got], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, last],
                                         names=["doc_id", "shard", "offset", "n_tokens",
                                                "ids" if payload else "ids_crc32"])
    if file is not None:
        file.close()


def _index_shard(shards: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")


def write_token_store(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int | None = None, shards: int | None = None,
                      keys_per_index: int = KEYS_PER_INDEX) -> TokenStore:
    """Encode every text and write payload, manifest and index below ``path``,
    which must not exist. ``shards``: payload files (default: the session's
    shuffle partitions)."""
    spark = docs.sparkSession
    python_stage(spark)
    enc = Encoder(tokenizer)
    width = 2 if enc.dtype == np.uint16 and (end_id or 0) < 1 << 16 else 4
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fs, base = _open(path)
    fs.create_dir(base)
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(partial(_write_ids, path=path, tokenizer=tokenizer, end_id=end_id, width=width),
                       PLACES).write.parquet(f"{path}/manifest")
    places = spark.read.schema(PLACES).parquet(f"{path}/manifest").filter("doc_id is not null")
    n_index = max(1, -(-places.count() // keys_per_index))
    store = TokenStore(path, width, n_index)
    (places.withColumn("index_shard", _index_shard(n_index)).groupBy("index_shard")
     .applyInPandas(partial(_write_index, path=path), "index_shard int, keys long")
     .write.parquet(f"{path}/indexed"))
    return store


def manifest(spark: SparkSession, store: TokenStore) -> DataFrame:
    return spark.read.schema(PLACES).parquet(f"{store.path}/manifest")


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Places of the rows of each distinct key in ``keys(doc_id)``, through
    the perfect hash index."""
    return (keys.select(F.col("doc_id").cast("long")).filter("doc_id is not null")
            .withColumn("index_shard", _index_shard(store.index_shards)).groupBy("index_shard")
            .applyInPandas(partial(_find, path=store.path), PLACES))


def fetch(store: TokenStore, places: DataFrame, payload: bool = True) -> DataFrame:
    """Add ``ids`` (or, without ``payload``, their ``ids_crc32``) read from the
    payload files."""
    python_stage(places.sparkSession)
    last = "ids array<long>" if payload else "ids_crc32 long"
    return (places.repartition("shard").sortWithinPartitions("shard", "offset")
            .mapInArrow(partial(_read_ids, path=store.path, width=store.width, payload=payload),
                        f"{PLACES}, {last}"))


def shard_starts(spark: SparkSession, store: TokenStore) -> DataFrame:
    """Ids before each payload shard: a running sum over one row per shard."""
    return (manifest(spark, store).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
            .withColumn("base", F.sum("n").over(Window.orderBy("shard")) - F.col("n")).drop("n"))


def digests(store: TokenStore, docs: DataFrame) -> DataFrame:
    """Per stored row, read back from the files: ``doc_id, start, n_tokens,
    ids_crc32, shard, offset``. Keys go through the index; rows without a key
    through the manifest."""
    spark = docs.sparkSession
    nameless = manifest(spark, store).filter("doc_id is null")
    got = fetch(store, locate(store, docs.select("doc_id")).union(nameless), payload=False)
    return got.join(shard_starts(spark, store), "shard").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "offset")
