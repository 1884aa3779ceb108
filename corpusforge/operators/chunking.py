"""Greedy size-bounded grouping (running sum with reset), exact.

Rule (per file, lines in order): add the line to the open chunk; once the
chunk's size reaches ``bound`` the chunk closes and the next line opens a
new one; the last partial chunk is kept.

The rule is sequential, so it runs as a two-pass scan that never puts a whole
file into one task:

1. Rows are range-partitioned by (file, line) — a hot file is split over
   many partitions — and checkpointed so both passes see the same partitions.
2. Pass 1 (``mapInPandas``): each partition summarises how its first file
   segment reacts to the state it inherits (open chunk size ``c``, chunk
   index ``k``).  After the first close inside the segment the state no
   longer depends on ``c``; a backward scan gives, for every possible first
   close, the chunks closed and the state at the end.  The summary has one
   entry per distinct threshold of ``c`` (at most ``min(rows, bound)``).
3. The driver composes the per-partition summaries in partition order
   (one small row per partition) into each partition's entering state.
4. Pass 2 (``mapInPandas``) replays each partition from its entering state
   and labels every row with its ``chunk_id``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.session import cut_lineage

SUMMARY_SCHEMA = T.StructType([
    T.StructField("pid", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("first_file", T.StringType()),
    T.StructField("last_file", T.StringType()),
    T.StructField("whole", T.BooleanType()),          # one file segment spans the partition
    T.StructField("seg_total", T.LongType()),          # size of the first segment
    T.StructField("thresholds", T.ArrayType(T.LongType())),  # c >= t_j  => first close at candidate j
    T.StructField("closes", T.ArrayType(T.LongType())),      # chunks closed in the segment for candidate j
    T.StructField("carries", T.ArrayType(T.LongType())),     # open size at segment end for candidate j
    T.StructField("tail_k", T.LongType()),             # last file's chunk index at the end (if not whole)
    T.StructField("tail_c", T.LongType()),             # last file's open size at the end (if not whole)
])


def _segment_table(sizes: np.ndarray, bound: int):
    """Backward scan over one segment: for a chunk opened at row i, the
    number of chunks it and its successors close, and the open size left."""
    m = len(sizes)
    closes = np.zeros(m + 1, dtype=np.int64)
    carry = np.zeros(m + 1, dtype=np.int64)
    pre = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    # end[i]: first j >= i with sum(i..j) >= bound, else m (no close)
    end = np.searchsorted(pre, pre[:-1] + bound, side="left") - 1
    end = np.maximum(end, np.arange(m))
    for i in range(m - 1, -1, -1):
        j = end[i]
        if j < m and pre[j + 1] - pre[i] >= bound:
            closes[i] = 1 + closes[j + 1]
            carry[i] = carry[j + 1]
        else:
            closes[i] = 0
            carry[i] = pre[m] - pre[i]
    return pre, closes, carry


def _summarise(pid: int, files: np.ndarray, sizes: np.ndarray, bound: int) -> dict:
    n = len(files)
    if n == 0:
        return dict(pid=pid, n=0, first_file=None, last_file=None, whole=True, seg_total=0,
                    thresholds=[], closes=[], carries=[], tail_k=0, tail_c=0)
    change = np.flatnonzero(files[1:] != files[:-1])
    seg_end = int(change[0]) + 1 if len(change) else n
    seg = sizes[:seg_end]
    pre, closes, carry = _segment_table(seg, bound)
    thresholds, cl, ca = [], [], []
    last_t = None
    for j in range(seg_end):
        t = bound - int(pre[j + 1])  # entering size c >= t closes the open chunk at row j
        if last_t is not None and t >= last_t:
            continue  # an earlier row already closes for these c
        thresholds.append(t)
        cl.append(1 + int(closes[j + 1]))
        ca.append(int(carry[j + 1]))
        last_t = t
        if t <= 0:
            break  # closes even with c = 0; later candidates are unreachable
    tail_k = tail_c = 0
    if seg_end < n:
        start = int(change[-1]) + 1
        _, cl2, ca2 = _segment_table(sizes[start:], bound)
        tail_k, tail_c = int(cl2[0]), int(ca2[0])
    return dict(pid=pid, n=n, first_file=str(files[0]), last_file=str(files[-1]), whole=seg_end == n,
                seg_total=int(pre[seg_end]), thresholds=thresholds, closes=cl, carries=ca,
                tail_k=tail_k, tail_c=tail_c)


def _apply(summary: dict, k: int, c: int) -> tuple[int, int]:
    """State leaving the first segment when it is entered with (k, c)."""
    for t, cl, ca in zip(summary["thresholds"], summary["closes"], summary["carries"]):
        if c >= t:
            return k + cl, ca
    return k, c + summary["seg_total"]


def greedy_chunks(df: DataFrame, file_col: str, order_col: str, size_col: str, bound: int,
                  num_partitions: int | None = None) -> DataFrame:
    """Adds ``chunk_id`` (0-based per file) to every row."""
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = (df.withColumn("_file", F.col(file_col).cast("string"))
         .repartitionByRange(num_partitions, "_file", order_col).sortWithinPartitions("_file", order_col))
    d = cut_lineage(d)  # both passes must see the very same partitions

    def pass1(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        parts = [b[["_file", size_col]] for b in batches]
        pdf = pd.concat(parts) if parts else pd.DataFrame({"_file": [], size_col: []})
        s = _summarise(TaskContext.get().partitionId(), pdf["_file"].to_numpy(dtype=object),
                       pdf[size_col].to_numpy(dtype=np.int64), bound)
        yield pd.DataFrame([s])

    summaries = sorted(d.select("_file", size_col).mapInPandas(pass1, SUMMARY_SCHEMA).collect(),
                       key=lambda r: r["pid"])
    entering: dict[int, tuple[int, int]] = {}
    prev_file, k, c = None, 0, 0
    for r in summaries:
        s = r.asDict()
        if s["n"] == 0:
            entering[s["pid"]] = (0, 0)
            continue
        if s["first_file"] != prev_file:
            k, c = 0, 0
        entering[s["pid"]] = (k, c)
        if s["whole"]:
            k, c = _apply(s, k, c)
        else:
            k, c = s["tail_k"], s["tail_c"]
        prev_file = s["last_file"]

    out_schema = T.StructType(list(d.schema.fields) + [T.StructField("chunk_id", T.LongType())])

    def pass2(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        k, c = entering.get(TaskContext.get().partitionId(), (0, 0))
        prev = None
        for pdf in batches:
            files = pdf["_file"].to_numpy(dtype=object)
            sizes = pdf[size_col].to_numpy(dtype=np.int64)
            ids = np.empty(len(pdf), dtype=np.int64)
            for i in range(len(pdf)):
                if prev is not None and files[i] != prev:
                    k, c = 0, 0
                prev = files[i]
                ids[i] = k
                c += int(sizes[i])
                if c >= bound:
                    k, c = k + 1, 0
            yield pdf.assign(chunk_id=ids)

    return d.mapInPandas(pass2, out_schema).drop("_file")


def chunk_texts(labelled: DataFrame, file_col: str, order_col: str, text_col: str) -> DataFrame:
    """Assemble each chunk's lines joined by newline (a chunk is bounded by
    ``bound`` plus one line, so no group is unbounded)."""
    g = labelled.groupBy(file_col, "chunk_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t")))).alias("_l"))
    return g.select(file_col, "chunk_id", F.array_join(F.transform("_l", lambda s: s["t"]), "\n").alias("text"),
                    F.size("_l").alias("n_lines"))
