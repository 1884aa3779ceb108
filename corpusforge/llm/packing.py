"""Vector best-fit packing of tokenized documents.

A document becomes its token ids and a final id 0; only longer ones are cut
into pieces of the sequence length, the first piece taking the rest.

Every piece is a demand vector (tokens, one document, attention cost =
length^2) and every sequence a residual vector.  Pieces go longest first to
the sequence that fits under every constraint and whose residual after
placement has the least weighted norm (``rule="norm"``) or whose residual has
the largest weighted dot product with the demand (``rule="dot"``).

With the defaults only the token capacity binds (pieces whose lengths sum to at
most the capacity keep the sum of their squares below its square), so the plan
is that of one-dimensional best fit; ``max_docs`` and ``max_attention`` make the
other two capacities bind.

All of that depends on the length of a piece only, so the plan is made from
the exact histogram of lengths (at most ``capacity`` numbers, whatever the
table) over classes of equally filled sequences, and the pieces are then
numbered inside their length and look their place up: the packing is that of
best-fit over the whole table, with no group of rows in one task.

Defined cases: null or empty text is one token (the final id); repeated ids
and rows are separate documents; null ids come back as null; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm import pretokens
from corpusforge.llm.common import id_in, id_out, written
from corpusforge.llm.wordmerge import merge_rounds

class CachedEncoder:
    """Ids of whole texts as the tokenizers library gives them."""

    def __init__(self, path: str):
        self.encoder = pretokens.load(path, merge_rounds)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for _, _, ids, per in self.encoder.encode(pa.array(texts, pa.string())):
            out += np.split(ids, np.cumsum(per)[:-1])
        return out


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32)."""
    src = docs.select(id_in(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        encoder = pretokens.load(tokenizer_path, merge_rounds)
        end = np.array([end_id], "<u4").tobytes()
        try:
            for b in batches:
                for row, rows, ids, per in encoder.encode(b.column(1)):
                    ids = ids.astype("<u4", copy=False)
                    raw, at = memoryview(ids.view(np.uint8)), 0
                    out = []
                    for doc, n in zip(b.column(0).slice(row, rows).to_pylist(), per.tolist()):
                        total = n + 1
                        s, p, e = 0, 0, total % capacity or min(total, capacity)
                        while s < total:
                            crc = zlib.crc32(raw[4 * (at + s):4 * (at + min(e, n))])
                            out.append((doc, p, s, e - s, crc if e <= n else zlib.crc32(end, crc)))
                            s, p, e = e, p + 1, e + capacity
                        at += n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                        names=["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            encoder.forget()
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_plan(histogram: dict[int, int], capacity: int, max_docs: int, max_attention: float,
                  weights=(1.0, 0.01, 0.01), rule: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, offset): piece of rank
    r lies in sequence ``first sequence + r - first rank`` at ``offset``."""
    cap = np.array([capacity, max_docs, max_attention], dtype=float)
    w = np.asarray(weights, dtype=float)
    res = np.empty((1024, 3))            # residuals of each class of sequences
    count = np.zeros(1024, np.int64)
    first = np.zeros(1024, np.int64)
    used, opened, runs = 0, 0, []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        need = np.array([length, 1, float(length) ** 2])
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((count[:used] > 0) & (res[:used] >= need).all(axis=1))
            if len(fits):
                r = res[fits] / cap
                if rule == "norm":
                    score = -(w * (r - need / cap) ** 2).sum(axis=1)
                else:
                    score = (w * r * (need / cap)).sum(axis=1) / np.sqrt((w * r * r).sum(axis=1) + 1e-12)
                c = int(fits[np.argmax(score)])
                n = int(min(left, count[c]))
                start, residual = int(first[c]), res[c].copy()
                count[c] -= n
                first[c] += n
            else:
                each = int(min(capacity // length, max_docs, max_attention // float(length) ** 2))
                n = -(-left // each)
                start, residual = opened, cap.copy()
                opened += n
            runs.append((length, rank, n, start, int(capacity - residual[0])))
            if used == len(count):
                res, count, first = (np.concatenate([x, np.zeros_like(x)]) for x in (res, count, first))
            res[used], count[used], first[used] = residual - need, n, start
            used += 1
            left, rank = left - n, rank + n
            if used > 512 and (count[:used] > 0).sum() < used // 2:       # forget classes used up
                live = np.flatnonzero(count[:used] > 0)
                res[:len(live)], count[:len(live)], first[:len(live)] = res[live], count[live], first[live]
                used = len(live)
    return runs


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         max_docs: int | None = None, max_attention: float | None = None, weights=(1.0, 0.01, 0.01),
         rule: str = "norm", end_id: int = 0, rows_per_bucket: int = 100_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).  The
    defaults of ``max_docs`` and ``max_attention`` never bind."""
    spark = docs.sparkSession
    p = written(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), "pieces")
    hist = {r.length: r.n for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}   # <= capacity rows
    runs = best_fit_plan(hist, capacity, max_docs or capacity, max_attention or float(capacity) ** 2, weights, rule)
    plan = spark.createDataFrame(runs, "length long, r0 long, n long, s0 long, offset long")
    # rank inside a length: buckets by hash, bucket totals, then a number inside the bucket
    nb = 1 + sum(hist.values()) // rows_per_bucket
    p = p.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(nb)))
    base = p.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start"))
    ranked = p.withColumn("rn", inside).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("rn") - 1)
    placed = ranked.join(plan, "length").where("rank >= r0 and rank < r0 + n")
    return placed.select(id_out("doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32",
                         (F.col("s0") + F.col("rank") - F.col("r0")).alias("sequence_id"), "offset")
