"""Byte-level BPE learning with maintained pair counts.

The word table is turned once into *blocks*: rows that hold the symbols of some
thousand words in one integer array, with the words' lengths and frequencies.
All pairs are counted over the blocks (``mapInArrow``, numpy inside; partial and
final aggregate), and the driver tracks every pair with at least ``threshold``
occurrences, exactly.  A place whose pair is rarer than that stays below the
threshold whatever is merged beside it, since a pair made there occurs at most
as often.  So words are cut at such places, and equal *segments* are counted
once: the table that the rounds work on, a small part of the words.

A round is one pass over the segments: all places of the round's merges are
found by binary search over the batch's pair keys, only the segments that hold
one are rewritten, and only *their* pairs, counted before and after, come out as
count differences, summed in the task and applied to the tracked pairs.  When
the tracked pairs run out, or a merge makes a symbol that existed before, the
merges so far are applied to the words in one pass and the pairs counted anew,
under a lower threshold.

Batches.  A round merges many pairs at once and still equals one merge at a
time.  Two different pairs can touch the same place only if the right symbol of
one is the left symbol of the other, so pairs are taken in order (count
descending, then left, then right symbol) until the first such conflict, with
count ``f``.  A pair that merging creates, (x, ab) or (ab, y), occurs at most as
often as (x, a) or (b, y), which both conflict with (a, b); so it has at most
``f`` occurrences and no pair above ``f`` can be overtaken.  At ``f`` itself:
(x, ab) sorts after every pair that sorts before (x, a); (ab, y) may sort
anywhere, so pairs with ``f`` occurrences are taken only while they sort before
every (ab, y) that could reach ``f``.  A pair of equal symbols, and one whose
merged symbol already exists, is merged alone.

Each round's segments are cached and every few rounds checkpointed in the shared
folder, so a lost executor repeats a few rounds at most.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "syms binary, lens binary, freqs binary"
#: about so many pairs are tracked on the driver
TRACKED = 50_000
MAX_BATCH = 512
#: tracked pairs reach down to 1/16 of the commonest one (quarter powers of two)
DEPTH = 16
#: segments of about so many bytes make a task of a round
ROUND_BYTES = 4 << 20
#: differences of more tasks are summed on the executors first
DIRECT_TASKS = 32


def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 32 | right.astype(np.int64)


def _word_of(lens: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lens)), lens)


def weighted_pairs(syms: np.ndarray, lens: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair key, word frequency) of every adjacent pair of the words."""
    word = _word_of(lens)
    inside = word[:-1] == word[1:]
    return _key(syms[:-1], syms[1:])[inside], freqs[word[:-1][inside]]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of values per distinct key, zero sums left out."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.add.reduceat(values, first)
    keep = total != 0
    return keys[first][keep], total[keep]


def merge_block(syms: np.ndarray, lens: np.ndarray, freqs: np.ndarray, batch: np.ndarray, made: np.ndarray):
    """Apply a batch (ascending pair keys, merged symbols).  Returns the block
    without words of one symbol and the count differences, or None if no word
    holds a pair of the batch."""
    if len(syms) < 2:
        return None
    word = _word_of(lens)
    key = _key(syms[:-1], syms[1:])
    at = np.minimum(np.searchsorted(batch, key), len(batch) - 1)
    hit = np.flatnonzero((batch[at] == key) & (word[:-1] == word[1:]))
    if not len(hit):
        return None
    # places overlap only in a run of one symbol (a a a): every second one
    run = np.concatenate([[True], np.diff(hit) != 1])
    hit = hit[(hit - hit[run][np.cumsum(run) - 1]) % 2 == 0]
    touched = np.zeros(len(lens), bool)
    touched[word[hit]] = True
    k0, f0 = weighted_pairs(syms[touched[word]], lens[touched], freqs[touched])
    new = syms.copy()
    new[hit] = made[at[hit]]
    stay = np.ones(len(syms), bool)
    stay[hit + 1] = False
    new, lens1 = new[stay], np.bincount(word[stay], minlength=len(lens))
    k1, f1 = weighted_pairs(new[touched[word[stay]]], lens1[touched], freqs[touched])
    differences = summed(np.concatenate([k0, k1]), np.concatenate([-f0, f1]))
    longer = lens1 > 1
    return new[np.repeat(longer, lens1)], lens1[longer], freqs[longer], differences


def _batch(block):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v.astype(t).tobytes()], pa.binary()) for v, t in zip(block, (np.int32, np.int64, np.int64))],
                                      names=["syms", "lens", "freqs"])


def _read(batch):
    """The blocks of an Arrow batch, one at a time and not copied."""
    for i in range(batch.num_rows):
        yield tuple(np.frombuffer(batch.column(j)[i].as_buffer(), t) for j, t in enumerate((np.int32, np.int64, np.int64)))


def blocks_of(words: DataFrame, code: dict[str, int]) -> DataFrame:
    """Blocks of a ``freq, syms`` table; ``code`` numbers the alphabet (bounded by it)."""
    def run(batches):
        import pyarrow.compute as pc

        for b in batches:
            lens = pc.list_value_length(b.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            symbols = pc.dictionary_encode(pc.list_flatten(b.column(0)))
            number = np.array([code[s] for s in symbols.dictionary.to_pylist()], np.int32)
            yield _batch((number[symbols.indices.to_numpy(zero_copy_only=False)], lens, b.column(1).to_numpy(zero_copy_only=False)))
    return words.where(F.size("syms") > 1).select("syms", F.col("freq").cast("long")).mapInArrow(run, BLOCK)


def _coded(batch: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """A batch of merges as ascending pair keys and merged symbols."""
    keys = _key(np.array([b[0] for b in batch]), np.array([b[1] for b in batch]))
    order = np.argsort(keys)
    return keys[order], np.array([b[2] for b in batch], np.int32)[order]


def merged(blocks: DataFrame, rounds: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Blocks after the merges of some rounds."""
    def run(batches):
        for b in batches:
            for block in _read(b):
                for keys, made in rounds:
                    done = merge_block(*block, keys, made)
                    block = block if done is None else done[:3]
                yield _batch(block)
    return blocks.mapInArrow(run, BLOCK)


def pair_table(blocks: DataFrame) -> DataFrame:
    """``l, r, c``: all adjacent pairs with their weighted counts."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for block in _read(b):
                keys, counts = summed(*weighted_pairs(*block))
                yield pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
                                                  pa.array(counts, pa.int64())], names=["l", "r", "c"])
    return blocks.mapInArrow(run, "l int, r int, c long").groupBy("l", "r").agg(F.sum("c").alias("c"))


def cut_block(syms: np.ndarray, lens: np.ndarray, freqs: np.ndarray, kept: np.ndarray):
    """Segments of a block's words, cut at every pair that is not among ``kept``
    (ascending keys): their symbols, lengths and frequencies, without single symbols."""
    word = _word_of(lens)
    key = _key(syms[:-1], syms[1:])
    at = np.minimum(np.searchsorted(kept, key), len(kept) - 1)
    first = np.flatnonzero(np.concatenate([[True], (kept[at] != key) | (word[:-1] != word[1:])]))
    size = np.diff(np.append(first, len(syms)))
    longer = size > 1
    return syms[np.repeat(longer, size)], size[longer], freqs[word[first[longer]]]


def segments(blocks: DataFrame, kept: np.ndarray) -> DataFrame:
    """Blocks of the distinct segments of all words."""
    def cut(batches):
        import pyarrow as pa

        for b in batches:
            for block in _read(b):
                if len(block[0]):
                    syms, size, freqs = cut_block(*block, kept)
                    ends = np.concatenate([[0], np.cumsum(size) * 4]).astype(np.int32)
                    parts = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(syms.astype(np.int32))])
                    yield pa.RecordBatch.from_arrays([parts, pa.array(freqs, pa.int64())], names=["seg", "freq"])

    def join(batches):
        import pyarrow.compute as pc

        for b in batches:
            lens = pc.binary_length(b.column(0)).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            syms = np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32)
            yield _batch((syms, lens, b.column(1).to_numpy(zero_copy_only=False)))

    table = blocks.mapInArrow(cut, "seg binary, freq long").groupBy("seg").agg(F.sum("freq").alias("freq"))
    return table.mapInArrow(join, BLOCK)


class Segments:
    """The segments as they are merged round by round."""

    def __init__(self, checkpoint_every: int):
        self.every, self.table, self.live, self.rounds = checkpoint_every, None, [], 0

    def close(self):
        for held in [*reversed(self.live), *([self.table] if self.table is not None else [])]:
            held.unpersist()
        self.live, self.table = [], None

    def fill(self, blocks: DataFrame, kept: np.ndarray):
        self.close()
        self.table = segments(blocks, kept).persist(StorageLevel.MEMORY_AND_DISK)
        size = self.table.agg(F.sum(F.octet_length("syms"))).first()[0] or 0
        rows = self.table.rdd.coalesce(max(1, -(-size // ROUND_BYTES)))
        self.live = [rows.map(lambda r: (np.frombuffer(r[0], np.int32), np.frombuffer(r[1], np.int64), np.frombuffer(r[2], np.int64)))
                     .persist(StorageLevel.MEMORY_AND_DISK)]

    def merge(self, keys: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One round: merge a batch everywhere; returns the count differences."""
        def run(blocks):
            k, c = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in blocks:
                if len(block) == 3:
                    done = merge_block(*block, keys, made)
                    if done is not None:
                        k.append(done[3][0])
                        c.append(done[3][1])
                    yield block if done is None else done[:3]
            yield summed(np.concatenate(k), np.concatenate(c))

        def both(x, y):
            return summed(np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]))

        after = self.live[-1].mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.live.append(after)
        self.rounds += 1
        reliable = self.rounds % self.every == 0        # survives executor loss, bounds lineage
        if reliable:
            after.checkpoint()
        found = after.filter(lambda x: len(x) == 2)
        differences = found.treeReduce(both) if found.getNumPartitions() > DIRECT_TASKS else found.reduce(both)
        if reliable:
            for held in reversed(self.live[:-1]):
                held.unpersist()
            self.live = [after]
        return differences


class Tracked:
    """Exact counts of all pairs with at least ``threshold`` occurrences, in
    merge order.  Symbols are numbers; ``names`` are their strings."""

    def __init__(self, names: list[str]):
        self.names, self.threshold = names, 1 << 62
        self.count: dict[tuple[int, int], int] = {}
        self.by_left: dict[int, set[int]] = defaultdict(set)
        self.queue: list[tuple[int, str, str, int, int]] = []
        self.ran_out = False      # the last batch ended with the tracked pairs

    def reset(self, rows, threshold: int):
        self.count, self.by_left, self.queue, self.threshold = {}, defaultdict(set), [], threshold
        for l, r, c in rows:
            self._put((l, r), c)

    def _put(self, p: tuple[int, int], c: int):
        if c < self.threshold:
            if self.count.pop(p, None) is not None:
                self.by_left[p[0]].discard(p[1])
            return
        self.count[p] = c
        self.by_left[p[0]].add(p[1])
        heapq.heappush(self.queue, (-c, self.names[p[0]], self.names[p[1]], *p))

    def add(self, rows):
        """Apply count differences.  A pair not tracked is new (its whole count
        is the difference) or stays below the threshold."""
        for l, r, d in rows:
            self._put((l, r), self.count.get((l, r), 0) + d)

    def ordered(self):
        """Tracked pairs in merge order; call ``give_back`` with those not merged."""
        while self.queue:
            c, ls, rs, l, r = heapq.heappop(self.queue)
            if self.count.get((l, r)) == -c:
                while self.queue and self.queue[0][3:] == (l, r) and self.queue[0][0] == c:
                    heapq.heappop(self.queue)
                yield (l, r), -c

    def give_back(self, pairs):
        for p in pairs:
            heapq.heappush(self.queue, (-self.count[p], self.names[p[0]], self.names[p[1]], *p))

    def batch(self, known: dict[str, int], limit: int) -> list[tuple[int, int]]:
        """The merges of one round, equal to one merge at a time."""
        names, taken, lefts, rights, made = self.names, [], set(), set(), set()
        spare, f, self.ran_out = [], self.threshold - 1, False
        for p, c in self.ordered():
            (l, r), string = p, names[p[0]] + names[p[1]]
            alone = l == r or string in known
            if alone and not taken:
                return [p]
            if alone or string in made or l in rights or r in lefts:
                spare, f = [p], c
                break
            taken.append((p, c))
            lefts.add(l)
            rights.add(r)
            made.add(string)
            if len(taken) == limit:
                f = c
                break
        else:
            self.ran_out = True
        first = None              # least (ab, y) that could reach f occurrences

        def seen(p):
            nonlocal first
            for y in self.by_left[p[1]]:
                if self.count[(p[1], y)] == f:
                    new = (names[p[0]] + names[p[1]], names[y])
                    first = new if first is None or new < first else first

        out = []
        for i, (p, c) in enumerate(taken):
            if i and c <= f and first is not None and first <= (names[p[0]], names[p[1]]):
                spare += [q for q, _ in taken[i:]]
                break
            out.append(p)
            if taken[-1][1] <= f:
                seen(p)
        self.give_back(spare)
        return out

    def fast_batch(self, known: dict[str, int], limit: int) -> list[tuple[int, int]]:
        """All pairs without a common symbol among the first ``limit`` (approximate)."""
        self.ran_out = False
        top = [p for p, _ in zip(self.ordered(), range(limit))]
        used, made, out = set(), set(), []
        for (l, r), _ in top:
            string = self.names[l] + self.names[r]
            alone = l == r or string in known or string in made
            if alone and not out:
                out = [(l, r)]
                break
            if not alone and l not in used and r not in used:
                out.append((l, r))
                used |= {l, r}
                made.add(string)
        self.give_back([p for p, _ in top if p not in set(out)])
        return out


def _refill(tracked: Tracked, blocks: DataFrame, min_frequency: int, size: int, depth: int | None) -> bool:
    """Count all pairs and track the most frequent; False if none is left.

    The threshold comes from a histogram of counts in quarter powers of two (a
    few hundred rows); at most about ``size`` pairs and ``depth`` steps below the
    first, or one step of the histogram, reach the driver."""
    table = pair_table(blocks).where(F.col("c") >= min_frequency).persist(StorageLevel.MEMORY_AND_DISK)
    step = F.floor(F.log2("c") * 4).cast("int")
    hist = {r["s"]: r["n"] for r in table.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()}
    total, low = 0, None
    for s in sorted(hist, reverse=True):
        if low is not None and (total + hist[s] > size or depth is not None and s < max(hist) - depth):
            break
        total, low = total + hist[s], s
    if low is not None:
        rows = table.where(step >= low).collect()
        # a step holds all pairs from its least count up; the last one, all there are
        least = min_frequency if low == min(hist) else min(r["c"] for r in rows)
        tracked.reset(((r["l"], r["r"], r["c"]) for r in rows), least)
    table.unpersist()
    return low is not None


def learn_merges(words: DataFrame, alphabet: list[str], symbols: set[str], budget: int, min_frequency: int = 2,
                 mode: str = "exact", fast_k: int = 32, checkpoint_every: int = 5, max_rounds: int | None = None,
                 tracked_pairs: int = TRACKED) -> tuple[list[tuple[str, str]], int]:
    """(merges in order, rounds) of a ``freq, syms`` table; ``symbols`` are all
    strings of the vocabulary so far (a merge that makes one of them is done
    alone)."""
    from corpusforge.session import cut_lineage, ensure_checkpoint_dir

    ensure_checkpoint_dir(words.sparkSession)
    names = list(alphabet)
    known = {s: i for i, s in enumerate(names)}
    reserved = {s: -1 for s in symbols if s not in known}
    merges: list[tuple[str, str]] = []
    blocks = blocks_of(words, known).persist(StorageLevel.MEMORY_AND_DISK)
    live, behind, rounds = Segments(checkpoint_every), [], 0     # ``behind``: rounds that the words have not seen
    tracked = Tracked(names)
    # the fast mode looks at the first pairs of the whole table
    depths = [DEPTH, None] if mode == "exact" else [None]
    tried = 0                     # depths tried since the last merge
    while len(merges) < budget and (max_rounds is None or rounds < max_rounds):
        left = min(budget - len(merges), MAX_BATCH)
        batch = (tracked.batch if mode == "exact" else lambda k, n: tracked.fast_batch(k, min(n, fast_k)))(
            known | reserved if reserved else known, left)
        short = not batch or tracked.ran_out
        if short and tried < len(depths) and not (tried and tracked.threshold <= min_frequency) and (
                not batch or tracked.threshold > min_frequency):
            if behind:
                done = cut_lineage(merged(blocks, behind))
                blocks.unpersist()
                blocks, behind = done, []
            if not _refill(tracked, blocks, min_frequency, tracked_pairs, depths[tried]):
                break
            pairs = np.array(list(tracked.count), np.int64)
            live.fill(blocks, np.sort(_key(pairs[:, 0], pairs[:, 1])))
            tried += 1
            continue
        if not batch:
            break
        tried = 0
        coded, again = [], False
        for l, r in batch:
            s = names[l] + names[r]
            again |= s in known
            if s not in known:
                known[s] = len(names)
                names.append(s)
            merges.append((names[l], names[r]))
            coded.append((l, r, known[s]))
        behind.append(_coded(coded))
        rounds += 1
        if len(merges) >= budget:
            break
        keys, counts = live.merge(*behind[-1])
        if again:                 # counts of pairs not tracked may have grown
            tracked.reset((), 1 << 62)
        else:
            seen = (counts < 0) | (counts >= tracked.threshold)
            tracked.add(zip((keys[seen] >> 32).tolist(), (keys[seen] & 0xFFFFFFFF).tolist(), counts[seen].tolist()))
    live.close()
    blocks.unpersist()
    return merges, rounds
