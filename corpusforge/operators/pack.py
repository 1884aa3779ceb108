"""Corpus assembly: token totals, the global stream, packing.

The reference concatenates a split's documents into one flat array and
views it as sequences.  Here the stream is never materialised: each document
knows its offset in its split's stream (an exclusive prefix sum, X1), and a
sequences inside a run of documents that lie together are cut in place.  Only
the pieces of sequences that cross a run's border are grouped, ``(L+1)`` tokens
at most, so no group is unbounded and the stream is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators.order import BUCKET, global_position


def n_sequences(n_tokens: Column, length: int, stride: int | None = None) -> Column:
    """C3/C4 count: ``max(0, (N - L - 1) div S + 1)``; stride 0/None means L."""
    s = stride or length
    return F.greatest(F.floor((n_tokens - F.lit(length) - 1) / F.lit(s)) + 1, F.lit(0)).cast("long")


def stream_offsets(tokenized: DataFrame, order_cols, ids_col: str = "ids",
                   stream_cols=("split",), reuse_buckets: bool = True,
                   bucket=None, bucket_bound: int = 16 ** 3) -> DataFrame:
    """C1 + C2: ``n_tokens`` per row and its exclusive offset in the stream of
    its ``stream_cols`` group, in ``order_cols`` order; plus stream totals
    ``tok_total`` and document counts.

    With ``reuse_buckets`` the input must carry X1's bucket column and range
    partitioning, and the prefix sum runs without a new shuffle.
    """
    d = tokenized.withColumn("n_tokens", F.size(ids_col).cast("long"))
    return global_position(d, order_cols, None if reuse_buckets else bucket,
                           partition_cols=list(stream_cols), sums={"tok": F.col("n_tokens")},
                           pos_col="stream_pos", total_col="stream_docs",
                           bucket_bound=bucket_bound, partition_fanout=4)


#: tokens of sequences made at once
_MADE = 2_000_000


def pack(streamed: DataFrame, length: int = 1024, stride: int | None = None,
         ids_col: str = "ids", stream_cols=("split",)) -> DataFrame:
    """C4 (+C3 with stride = L): strided fixed-length sequences.

    Sequence ``i`` of a stream holds tokens ``[i*S, i*S + L]`` (L+1 tokens);
    there are ``max(0, (N-L-1) div S + 1)``.  Input: ``stream_offsets`` output.
    Output: ``<stream_cols>, seq_id, tokens`` (L+1 ids).

    The rows of a bucket are one run of their stream.  Sequences inside a run
    are cut where the run lies; only tokens of sequences that cross a run's
    border, at most L on either side for S = L, are shuffled.
    """
    L, S = length, (stride or length)
    return _inside_runs(streamed, L, S, ids_col, stream_cols).unionByName(
        _across_runs(streamed, L, S, ids_col, stream_cols))


def _inside_runs(streamed: DataFrame, L: int, S: int, ids_col: str, stream_cols, sep: str | None = None) -> DataFrame:
    """Sequences that lie inside one run.  The window only asks for a bucket's
    rows together and in order, which the range partitioning of X1 already gives.

    With ``sep`` the sequences come as the texts ``input_ids`` and ``target_ids``."""
    place = F.row_number().over(Window.partitionBy(*stream_cols, BUCKET).orderBy("tok_offset", "stream_pos"))
    src = streamed.withColumn("_place", place).select(
        *stream_cols, "_place", F.col("tok_offset").alias("_at"), F.col(ids_col).alias("_ids"))
    keys = len(stream_cols)
    made = [T.StructField("tokens", src.schema["_ids"].dataType)] if sep is None else [
        T.StructField(c, T.StringType()) for c in ("input_ids", "target_ids")]
    schema = T.StructType([src.schema[c] for c in stream_cols] + [T.StructField("seq_id", T.LongType()), *made])
    at_once = max(1, _MADE // (L + 1))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def lists(held, first, n, size):
            tokens = held[(first + np.arange(n) * S)[:, None] + np.arange(size)].ravel()
            return pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(tokens)

        def sequences(held, first, n):
            if sep is None:
                return [pa.ListArray.from_arrays(*lists(held, first, n, L + 1))]
            shifted = [lists(held, first + k, n, L) for k in (0, 1)]
            return [pc.binary_join(pa.ListArray.from_arrays(o, t.cast(pa.string())), sep) for o, t in shifted]

        held, base, nxt = np.zeros(0, np.int32), 0, 0      # tokens from ``base``; first sequence not yet cut
        for b in batches:
            ids = b.column(keys + 2)
            sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            place, at = (b.column(keys + j).to_numpy(zero_copy_only=False) for j in (0, 1))
            cuts = [0, *(np.flatnonzero(place[1:] == 1) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if place[s] == 1:
                    held, base = held[:0], int(at[s])
                    nxt = -(-base // S)
                held = np.concatenate([held, flat[ends[s]:ends[e]]])
                n = (base + len(held) - 1 - L) // S - nxt + 1
                while n > 0:
                    m = min(n, at_once)
                    same = pa.array(np.full(m, s))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(j).take(same) for j in range(keys)] + [
                            pa.array(np.arange(nxt, nxt + m)), *sequences(held, nxt * S - base, m)],
                        names=schema.names)
                    nxt, n = nxt + m, n - m
                drop = min(max(nxt * S - base, 0), len(held))
                held, base = held[drop:], base + drop
    return src.mapInArrow(run, schema)


def _across_runs(streamed: DataFrame, L: int, S: int, ids_col: str, stream_cols) -> DataFrame:
    """Sequences that cross a run's border, from the pieces near the borders."""
    o, n = F.col("tok_offset"), F.col("n_tokens")
    start, end = F.col("tok_run_start"), F.col("tok_run_end")
    n_seq = n_sequences(F.col("tok_total"), L, S)
    lo = F.greatest(F.ceil((o - F.lit(L)) / F.lit(S)), F.lit(0)).cast("long")
    hi = F.least(F.floor((o + n - 1) / F.lit(S)).cast("long"), n_seq - 1)
    none = F.array().cast("array<bigint>")

    def span(a, b):
        return F.when((n > 0) & (b >= a), F.sequence(a, b)).otherwise(none)

    before = span(lo, F.least(hi, F.ceil(start / F.lit(S)).cast("long") - 1))             # start before the run
    after = span(F.greatest(lo, F.ceil((end - L) / F.lit(S)).cast("long")), hi)           # end beyond it
    near = streamed.where((o < start + L) | (o + n > end - L))
    pieces = near.select(*stream_cols, o.alias("_o"), n.alias("_n"), F.col(ids_col).alias("_ids"),
                         F.explode(F.array_union(before, after)).alias("seq_id"))
    first = F.greatest(F.col("seq_id") * S, F.col("_o"))
    last = F.least(F.col("seq_id") * S + L, F.col("_o") + F.col("_n") - 1)
    piece = F.slice("_ids", (first - F.col("_o") + 1).cast("int"), (last - first + 1).cast("int"))
    pieces = pieces.select(*stream_cols, "seq_id", F.struct(first.alias("s"), piece.alias("p")).alias("_piece"))
    seqs = pieces.groupBy(*stream_cols, "seq_id").agg(F.array_sort(F.collect_list("_piece")).alias("_ps"))
    return seqs.select(*stream_cols, "seq_id", F.flatten(F.transform("_ps", lambda x: x["p"])).alias("tokens"))


def shift(tokens: Column | str, length: int) -> list[Column]:
    """``input_ids = x[:-1]``, ``target_ids = x[1:]`` for an (L+1)-array."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return [F.slice(t, 1, length).alias("input_ids"), F.slice(t, 2, length).alias("target_ids")]


def packed_sequences(streamed: DataFrame, length: int = 1024, stride: int | None = None,
                     ids_col: str = "ids", stream_cols=("split",)) -> DataFrame:
    """C4 + C5: ``<stream_cols>, seq_id, input_ids, target_ids``."""
    p = pack(streamed, length, stride, ids_col, stream_cols)
    return p.select(*stream_cols, "seq_id", *shift("tokens", length))


def packed_texts(streamed: DataFrame, length: int = 1024, stride: int | None = None,
                 ids_col: str = "ids", stream_cols=("split",), sep: str = " ") -> DataFrame:
    """``packed_sequences`` with both id lists as texts, written where the
    sequences are cut."""
    L, S = length, (stride or length)
    across = _across_runs(streamed, L, S, ids_col, stream_cols).select(*stream_cols, "seq_id", *shift("tokens", L))
    texts = [F.array_join(c, sep).alias(c) for c in ("input_ids", "target_ids")]
    return _inside_runs(streamed, L, S, ids_col, stream_cols, sep).unionByName(across.select(*stream_cols, "seq_id", *texts))


def stream_summary(streamed: DataFrame, length: int, stride: int | None = None,
                   batch_size: int = 8, stream_cols=("split",)) -> DataFrame:
    """C1 + C6: documents, tokens, sequences and batches per stream."""
    g = streamed.groupBy(*stream_cols).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens"))
    nseq = n_sequences(F.col("n_tokens"), length, stride)
    return g.select(*stream_cols, "n_docs", "n_tokens", nseq.alias("n_sequences"),
                    F.ceil(nseq / F.lit(batch_size)).cast("long").alias("n_batches"),
                    F.floor(nseq / F.lit(batch_size)).cast("long").alias("n_full_batches"))
