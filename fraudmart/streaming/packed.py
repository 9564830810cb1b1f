"""Waiting rows of a group of keys as packed Arrow tables.

Shared by the keyed states (``stateful``, ``typed``): keys are dealt by hash into
``GROUPS`` groups, so Python is called, timers stand and states are read once per
group, not once per key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Groups the keys are dealt into. A checkpoint keeps the number it began with.
GROUPS = 1024

# the process beside the driver that starts a typed processor cannot import this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def group_of(key: str, groups: int = GROUPS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(groups))


def fresh(frames: Iterator[pd.DataFrame], schema: pa.Schema, wm: int) -> list[pa.Table]:
    """The rows that arrived; what is behind the watermark comes too late for the order."""
    out = []
    for pdf in frames:
        pdf = pdf[pdf["sec"] * 1000 > wm]
        if len(pdf):
            out.append(pa.Table.from_pandas(pdf[schema.names], schema=schema, preserve_index=False))
    return out


def pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(packed))).read_all()


def runs(ready: pa.Table) -> Iterator[tuple[str | None, list[dict]]]:
    """The ready rows of one key after the other, each in (ts, trans_id, city) order."""
    order = [c for c in ("key", "ts", "trans_id", "terminal_city") if c in ready.column_names]
    ready = ready.take(pc.sort_indices(ready, [(c, "ascending") for c in order], null_placement="at_start"))
    columns = {c: ready.column(c).to_pylist() for c in ready.column_names}
    keys = columns.pop("key")
    start = 0
    for end in range(1, len(keys) + 1):
        if end == len(keys) or keys[end] != keys[start]:
            yield keys[start], [dict(zip(columns, r)) for r in zip(*(v[start:end] for v in columns.values()))]
            start = end
