"""SimHash near-dedup with a generalised pigeonhole search.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``words`` words joined by one space (repeats count; fewer words: the whole
sequence; none: fingerprint zero), XXH64 with seed 42 per shingle, a bit is 1
if set in over half of the hashes.

Search over the distinct fingerprints: bits that go together are grouped into
one partition (greedy on the correlations over all fingerprints).  For
``max_bits`` = t and m partitions, thresholds T_i >= -1 with
sum T_i = t - m + 1 cannot miss a pair: if partition i differed in more than
T_i bits for every i, the pair would differ in more than t.  A dynamic program
picks the T_i (and m) of least cost = probe keys + estimated candidates, the
latter from the agreement rates of the bits and the table size.  Every
fingerprint goes to its own key in each partition and to all keys within T_i
bits; pairs that meet are verified by their full distance.  Keys with more
than ``block`` rows are split into pairs of blocks.  A task returns a spanning
forest of what it links, never all pairs.

Defined cases: null or blank text: fingerprint zero, linked like any other;
null ids are kept, sort first in a component, and come back as null; repeated
ids and rows are each returned; other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import as_numpy, group_starts, id_in, id_out, sorted_runs, text_bytes, to_batches, written
from corpusforge.llm.components import connected_components
from corpusforge.operators.skew import hot_keys, join_hot

BITS = 64
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text (whole)."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()          # bytes.lower changes A-Z only
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        return xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    stop = ends[words - 1:].tolist()
    start = [0, *(ends[:len(stop) - 1] + 1).tolist()]
    votes, n = np.zeros(BITS, np.int64), len(stop)
    for c in range(0, n, 250_000):    # bounded memory for very long texts
        h = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(start[c:c + 250_000], stop[c:c + 250_000])),
                        np.uint64, min(250_000, n - c))
        cut = np.arange(0, len(h), 255)
        for j in range(8):            # eight bits at once, one byte lane each
            lanes = np.add.reduceat((h >> np.uint64(j)) & _LANES, cut)
            votes[j::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(votes * 2 > n).tolist()))


def _mark(text_col: str):
    """64 bits of a text, beside its crc32: many rows may share a null id."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    src = docs.select(id_in(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), _mark(text_col).alias("mark"))

    def run(batches):
        for b in batches:
            texts = text_bytes(b, "text")
            fp = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                                              b.column(2), pa.array(fp.view(np.int64))], names=["doc_id", "tag", "mark", "fp"])
    return src.mapInArrow(run, "doc_id long, tag long, mark long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(n, 64x64 co-occurrence counts) over all distinct fingerprints."""
    def run(batches):
        n, co = 0, np.zeros((BITS, BITS))
        for b in batches:
            v = np.ascontiguousarray(as_numpy(b, "fp")).view(np.uint8).reshape(-1, 8)
            x = np.unpackbits(v, axis=1, bitorder="little").astype(np.float32)
            co += x.T @ x
            n += len(x)
        yield from to_batches(pa.schema([("i", pa.int32()), ("c", pa.float64())]),
                              [np.arange(BITS * BITS + 1), np.append(co.ravel(), n)], 8192)
    rows = fps.select("fp").mapInArrow(run, "i int, c double").groupBy("i").agg(F.sum("c").alias("c")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:                    # 4097 numbers whatever the table size
        flat[r.i] = r.c
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, co: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of about 64/m bits, correlated bits together."""
    p = np.diag(co) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((co / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, parts = list(range(BITS)), []
    for i in range(m):
        size = -(-len(left) // (m - i))
        part = [left.pop(0)]
        while len(part) < size:
            best = max(left, key=lambda b: (corr[b, part].mean(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def allocate(n: int, p: np.ndarray, parts: list[list[int]], t: int, probe_cost: float, pair_cost: float):
    """Thresholds of least cost with sum t - m + 1, by dynamic programming."""
    costs = []
    for part in parts:
        dist = np.array([1.0])        # chance of each distance between two fingerprints
        for b in part:
            d = 2 * p[b] * (1 - p[b])
            dist = np.convolve(dist, [1 - d, d])
        row = {-1: 0.0}
        for r in range(t + 1):
            keys = sum(comb(len(part), j) for j in range(min(r, len(part)) + 1)) + 1
            row[r] = n * keys * probe_cost + n * n * float(dist[:r + 1].sum()) * pair_cost
        costs.append(row)
    best = {0: (0.0, [])}
    for row in costs:
        step: dict = {}
        for used, (c, chosen) in best.items():
            for r, rc in row.items():
                if used + r not in step or c + rc < step[used + r][0]:
                    step[used + r] = (c + rc, [*chosen, r])
        best = step
    return best[t - len(parts) + 1]


def plan_search(n: int, co: np.ndarray, t: int, probe_cost: float = 2e-6, pair_cost: float = 3e-9):
    """Best (partitions, thresholds) over the numbers of partitions."""
    p = np.diag(co) / max(n, 1)
    options = []
    for m in range(1, t + 3):
        parts = group_bits(n, co, m)
        if m == 1 and t > 2:
            continue                  # a ball over all 64 bits
        cost, thresholds = allocate(n, p, parts, t, probe_cost, pair_cost)
        options.append((cost, parts, thresholds))
    return min(options, key=lambda o: o[0])[1:]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _probes(parts, thresholds):
    """Each fingerprint under its own key (indexed) and under all keys within
    the threshold (probing)."""
    masks = [np.uint64(sum(1 << b for b in part)) for part in parts]
    flips = [np.array([sum(1 << b for b in c) for r in range(1, T + 1) for c in combinations(part, r)], dtype=np.uint64)
             for part, T in zip(parts, thresholds)]
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("fp", pa.int64()), ("own", pa.bool_())])

    def run(batches):
        for b in batches:
            fps = np.ascontiguousarray(as_numpy(b, "fp")).view(np.uint64)
            for c in range(0, len(fps), 2000):
                fp = fps[c:c + 2000]
                for i, T in enumerate(thresholds):
                    if T < 0:
                        continue
                    own = fp & masks[i]
                    keys = np.concatenate([own[:, None], own[:, None] ^ flips[i][None, :]], axis=1)
                    n = keys.shape[1]
                    mine = np.zeros(keys.shape, bool)
                    mine[:, 0] = True
                    yield from to_batches(schema, [np.full(keys.size, i, np.int32), keys.ravel().view(np.int64),
                                                   np.repeat(fp, n).view(np.int64), mine.ravel()], 100_000)
    return run


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _verify(t: int, step: int = 512):
    """Per group: indexed fingerprints against all of the group, in blocks of
    numpy, full distance <= t; returns the edges of a spanning forest."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for tab in sorted_runs(batches, ["part", "key", "bi", "bj"], 50_000):
            starts = np.append(group_starts(tab, ["part", "key", "bi", "bj"]), tab.num_rows)
            fp = tab.column("fp").to_numpy().view(np.uint64)
            own = tab.column("own").to_numpy(zero_copy_only=False)
            out_a, out_b = [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if e - s < 2 or not own[s:e].any():
                    continue
                rows, mine = fp[s:e], np.flatnonzero(own[s:e])
                forest = _Forest(e - s)
                for c in range(0, len(mine), step):
                    m = mine[c:c + step]
                    x, y = np.nonzero(popcount(rows[m][:, None] ^ rows[None, :]) <= t)
                    x = m[x]
                    live = x != y
                    for i, j in zip(x[live].tolist(), y[live].tolist()):
                        if forest.join(i, j):
                            out_a.append(rows[i])
                            out_b.append(rows[j])
            if out_a:
                yield from to_batches(schema, [np.array(out_a, np.uint64).view(np.int64),
                                               np.array(out_b, np.uint64).view(np.int64)])
    return run


def links(fps: DataFrame, t: int, block: int = 4096, parts=None, thresholds=None) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within t bits."""
    if parts is None:
        n, co = bit_statistics(fps)
        parts, thresholds = plan_search(n, co, t)
    probes = fps.select("fp").mapInArrow(_probes(parts, thresholds), "part int, key long, fp long, own boolean")
    # keys with many indexed rows: every row goes to the pairs of blocks it is part of
    hot = (fps.select("fp").mapInArrow(_probes(parts, [min(T, 0) for T in thresholds]),
                                       "part int, key long, fp long, own boolean")
           .groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
           .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("nb")))
    j = probes.join(hot, ["part", "key"], "left").withColumn(
        "bk", F.when(F.col("nb").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int")))
    j = (j.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("nb", F.lit(1)) - 1)))
         .select("part", "key", "fp", "own", F.least("bk", "other").alias("bi"), F.greatest("bk", "other").alias("bj")))
    keys = ["part", "key", "bi", "bj"]
    return j.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(t), "a long, b long")


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, max_bits: int, block: int) -> DataFrame:
    """(doc_id, tag, mark, fp, node, component) per input row.  ``node``: the
    smallest fingerprint of the group, its identity; ``component``: the
    smallest id, which several groups share if ids are null or repeat."""
    fp = written(fingerprints(docs, id_col, text_col, words), "simhash")
    reps = written(fp.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-distinct")
    pairs = links(reps, max_bits, block)
    # nodes are fingerprints: an id may stand for several of them if ids repeat
    comp = connected_components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "fp")
    named = comp.join(reps.select("fp", "rep"), "fp")
    least = named.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("n"))
    label = join_hot(named, least.select("component", "least"), "component", hot_keys(least, "component", "n"),
                     F.col("fp")).select("fp", "least", F.col("component").alias("node"))
    per_fp = reps.join(label, "fp", "left").select("fp", F.coalesce("node", "fp").alias("node"),
                                                   F.coalesce("least", "rep").alias("component"))
    # one fingerprint may belong to a third of all documents (empty texts, copies)
    return join_hot(fp, per_fp, "fp", hot_keys(reps, "fp", "n"), F.struct("doc_id", "tag"))


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                   max_bits: int = 4, block: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id) per input row."""
    return _labelled(docs, id_col, text_col, words, max_bits, block).select(
        id_out("doc_id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        id_out("component").alias("component_id"))


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4,
                  block: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one of smallest id
    (then smallest crc32 of its text; of repeated identical rows one).  Groups
    are told apart by their fingerprints: documents that share an id, or have
    none, are near duplicates only if their texts are."""
    got = _labelled(docs, id_col, text_col, words, max_bits, block)
    row = ["id", "tag", "mark"]
    keep = got.groupBy("node").agg(F.min(F.struct(F.col("doc_id").alias("id"), "tag", "mark")).alias("k")).select("k.*")
    rows = docs.select(F.struct("*").alias("row"), id_in(id_col).alias("id"),
                       F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tag"), _mark(text_col).alias("mark"))
    return rows.join(keep, row, "left_semi").dropDuplicates(row).select("row.*")
