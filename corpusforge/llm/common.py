"""Helpers shared by the training-data operators of this subpackage.

Null ids: every operator maps a null document id to ``NULL_ID`` inside (so it
sorts before all others) and gives null back in its result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import scratch_path

NULL_ID = -(2 ** 63)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts the lineage,
    survives lost executors, and lets several consumers share one run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_in(col) -> F.Column:
    return F.coalesce(F.col(col).cast("long") if isinstance(col, str) else col.cast("long"), F.lit(NULL_ID))


def id_out(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != F.lit(NULL_ID), c)


def as_numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string or binary column as bytes objects (null: empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    return [b if b is not None else b"" for b in col.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], target_rows: int) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``keys`` so that each piece holds whole key
    groups and about ``target_rows`` rows (one larger group stays whole: the
    caller bounds its group sizes)."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < target_rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        differs = np.zeros(n - 1, dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            differs |= v[1:] != v[:-1]
        cuts = np.flatnonzero(differs)
        if not len(cuts):
            continue
        cut = int(cuts[-1]) + 1
        yield t.slice(0, cut)
        held = t.slice(cut).to_batches()
        n -= cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key group starts."""
    new = np.zeros(t.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def to_batches(schema: pa.Schema, columns: list, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_arrays([pa.array(c, type=f.type) if not isinstance(c, (pa.Array, pa.ChunkedArray)) else c
                              for c, f in zip(columns, schema)], schema=schema)
    yield from t.to_batches(max_chunksize=rows)


def lookup(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)
