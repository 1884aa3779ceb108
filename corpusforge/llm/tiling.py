"""Benchmark decontamination by greedy string tiling.

Words are maximal runs of letters and digits, lower-cased.  A document and a
benchmark item that share a seed (``min_match`` consecutive words) are tiled:
Running Karp-Rabin finds the longest matches of unmarked words, marks them
longest first without overlap, and goes on with shorter ones down to
``min_match``.  The covered share of the item's words does not depend on the
order of its passages, so a reordered item is caught too.  A document with an
item of coverage >= ``threshold`` is contaminated.

The benchmark is a stated query set against all documents: it is taken in
shards of at most about ``shard_bytes`` of text, each collected and broadcast,
so the broadcast is bounded however large the benchmark is.  Documents pass
each shard row by row; nothing is shuffled.

Defined cases: null or empty texts and items match nothing; items of fewer
than ``min_match`` words match nothing; null item ids stay null in the lists;
repeated items and documents are each judged; an empty benchmark leaves every
document clean.  All columns of the documents are kept, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
_BASE = 1_000_003
_MOD = (1 << 61) - 1


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _rolling(symbols: list[int], n: int):
    """Karp-Rabin hashes of all windows of n symbols."""
    h, top = 0, pow(_BASE, n, _MOD)
    for i, s in enumerate(symbols):
        h = (h * _BASE + s + 2) % _MOD
        if i >= n:
            h = (h - (symbols[i - n] + 2) * top) % _MOD
        if i >= n - 1:
            yield i - n + 1, h


def tile(pattern: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (pattern start, text start, words), longest first."""
    marked_p, marked_t = [False] * len(pattern), [False] * len(text)
    tiles, size = [], min(len(pattern), len(text))
    while size >= min_match:
        table = defaultdict(list)
        for i, h in _rolling(pattern, size):
            if not any(marked_p[i:i + size]):
                table[h].append(i)
        found = []
        if table:
            for j, h in _rolling(text, size):
                for i in table.get(h, ()):
                    if pattern[i:i + size] == text[j:j + size] and not any(marked_t[j:j + size]):
                        found.append((i, j))
        for i, j in found:
            if not any(marked_p[i:i + size]) and not any(marked_t[j:j + size]):
                marked_p[i:i + size] = marked_t[j:j + size] = [True] * size
                tiles.append((i, j, size))
        # the longest possible match among what is still unmarked
        size = min(size - 1, max(map(len, "".join("x " [m] for m in marked_p).split()), default=0))
    return tiles


class _Shard:
    """Seeds of some benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.k = min_match
        self.ids = [i for i, _ in items]
        self.vocab: dict[str, int] = {}
        self.items = [[self.vocab.setdefault(w, len(self.vocab)) for w in words(t)] for _, t in items]
        seeds = defaultdict(set)
        for n, it in enumerate(self.items):
            if len(it) >= min_match:
                for h in self._grams(np.array(it, np.int64)).tolist():
                    seeds[h].add(n)
        self.seeds = {h: sorted(s) for h, s in seeds.items()}
        self.sorted = np.array(sorted(self.seeds), dtype=np.uint64)

    def _grams(self, ids: np.ndarray) -> np.ndarray:
        h = np.zeros(len(ids) - self.k + 1, dtype=np.uint64)
        for j in range(self.k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j:len(ids) - self.k + 1 + j].astype(np.uint64) + np.uint64(1)
        return h

    def coverage(self, text: str, threshold: float) -> list[tuple[int | None, float]]:
        get = self.vocab.get
        ids = [get(w, -1) for w in words(text)]
        if len(ids) < self.k or not len(self.sorted):
            return []
        a = np.array(ids, np.int64)
        known = np.cumsum(np.concatenate([[0], a >= 0]))
        whole = known[self.k:] - known[:-self.k] == self.k
        if not whole.any():
            return []
        h = self._grams(a)
        at = np.searchsorted(self.sorted, h)
        hits = np.flatnonzero(whole & (self.sorted[np.minimum(at, len(self.sorted) - 1)] == h))
        by_item = defaultdict(list)
        for p in hits.tolist():
            for n in self.seeds[int(h[p])]:
                by_item[n].append(p)
        out = []
        for n, places in by_item.items():
            item = self.items[n]
            # tiles lie inside the seeds' words: keep those, parted where words are left out
            keep, last = [], -1
            for p in places:
                if p > last:
                    keep.append(-1)
                keep.extend(ids[max(p, last):p + self.k])
                last = p + self.k
            c = sum(t[2] for t in tile(item, keep, self.k)) / len(item)
            if c >= threshold:
                out.append((self.ids[n], c))
        return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_match: int = 5, threshold: float = 0.5,
                  shard_bytes: int = 8_000_000) -> DataFrame:
    """(row: struct of all columns, hits array<struct<item_id, coverage>>)."""
    spark = docs.sparkSession
    b = benchmark.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("t"))
    total = b.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = 1 + int(total) // shard_bytes
    out = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"),
                      F.array().cast("array<struct<item_id:long,coverage:double>>").alias("hits"))
    schema = out.schema
    for s in range(shards):
        rows = b.where(F.pmod(F.xxhash64("item", "t"), F.lit(shards)) == s).collect()
        shared = spark.sparkContext.broadcast(sorted(((r.item, r.t) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))

        def run(batches, shared=shared):
            shard = _Shard(shared.value, min_match)
            hit = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64())]))
            for batch in batches:
                hits = []
                for text, before in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    new = [{"item_id": i, "coverage": c} for i, c in shard.coverage(text or "", threshold)]
                    hits.append((before or []) + new)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, hit)], names=["row", "text", "hits"])
        out = out.mapInArrow(run, schema)
    return out.select("row", "hits")
