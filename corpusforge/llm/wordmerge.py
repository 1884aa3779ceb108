"""BPE encoding and decoding by batched merge rounds.

The symbols of many distinct pre-tokens lie in one flat array.  A round looks
up the rank of every adjacent pair by binary search over the sorted pair keys
(left id x size + right id), takes the lowest rank of each pre-token, merges
all its places from left to right and closes the gaps; only pairs beside a
merged place are looked up again, and pre-tokens without a ranked pair leave.
A pre-token of n symbols needs fewer than n rounds.  Pre-tokens of over
``LONG`` symbols go by ascending rank through a linked list in arrays instead,
so that a run of a million letters costs n log n, not n rounds over all of it.

Decoding gathers the bytes of all ids of a batch in one step; bytes that are no
UTF-8 become U+FFFD as in the library.

Both are row-wise: no shuffle, texts stay in their partition; a worker keeps
one vocabulary, a task a bounded store of pre-tokens.

Defined cases: null or empty text has no ids and decodes to the empty text; a
text that holds an added token's string gets that token, as the library does;
repeated rows and ids are each answered; null ids come back as null; very long
texts are cut where a pre-token starts anyway; other columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.llm import pretokens
from corpusforge.llm.pretokens import LONG, per_worker

NONE = np.int64(2 ** 62)


def byte_symbols() -> dict[str, int]:
    """The published byte alphabet: printable Latin-1 stands for itself, the
    other bytes for the code points from 256 up."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Pair keys in ascending order with their ranks, and merged ids by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1, np.int64)
        born[self.made] = np.arange(len(merges))
        if len(np.unique(self.made)) < len(merges) or (np.maximum(born[key // self.size], born[key % self.size]) >= np.arange(len(merges))).any():
            raise ValueError("merges must stand in learning order, one for each merged symbol")
        order = np.argsort(key)
        self.keys, self.ranks, self.key_of = key[order], order.astype(np.int64), key
        self.byte_id = np.zeros(256, np.int64)
        for c, b in byte_symbols().items():
            self.byte_id[b] = vocab[c]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per word)."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), n)
        long = (n > LONG)[word]
        parts = [self.rounds(sym[~long], word[~long]), self.by_rank(sym[long], word[long])]
        sym, word = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.uint32), np.bincount(word, minlength=len(words))

    def rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over symbols of many words (``word`` ascending)."""
        done = [(sym[:0], word[:0])]
        rank = np.full(len(sym), NONE)
        if len(sym):
            same = word[:-1] == word[1:]
            rank[:-1][same] = self.rank(sym[:-1][same], sym[1:][same])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), size)
            over = least == NONE
            if over.any():
                done.append((sym[over], word[over]))
                sym, word, rank, least = (x[~over] for x in (sym, word, rank, least))
                continue
            hit = np.flatnonzero(rank == least)
            # places of one pair that overlap (a a a): every second one of a run
            run = np.concatenate([[True], np.diff(hit) != 1])
            head = hit[run][np.cumsum(run) - 1]
            hit = hit[(hit - head) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            changed = np.zeros(len(sym), bool)
            changed[hit] = True
            changed[np.maximum(hit - 1, 0)] = True
            back = hit[hit >= 2]
            changed[back - 2] |= ~stay[back - 1]              # the symbol before was merged too
            sym, word, rank, changed = (x[stay] for x in (sym, word, rank, changed))
            at = np.flatnonzero(changed)
            rank[at] = NONE
            at = at[at + 1 < len(sym)]
            at = at[word[at] == word[at + 1]]
            rank[at] = self.rank(sym[at], sym[at + 1])
        return tuple(np.concatenate(x) for x in zip(*done))

    def by_rank(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges by ascending rank over a linked list: places of a
        rank wait in its bucket and are checked when the rank's turn comes."""
        n = len(sym)
        if not n:
            return sym, word
        after = np.append(np.arange(1, n), -1)
        after[:-1][word[1:] != word[:-1]] = -1
        before = np.full(n, -1, np.int64)
        before[after[after >= 0]] = np.flatnonzero(after >= 0)
        alive = np.ones(n, bool)
        buckets: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def put(at: np.ndarray):
            at = at[after[at] >= 0]
            r = self.rank(sym[at], sym[after[at]])
            at, r = at[r < NONE], r[r < NONE]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            for x, places in zip(r[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if x not in buckets:
                    heapq.heappush(queue, x)
                    buckets[x] = []
                buckets[x].append(places)

        put(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(buckets.pop(r)))
            at = at[alive[at] & (after[at] >= 0)]
            at = at[sym[at] * self.size + sym[after[at]] == self.key_of[r]]
            if not len(at):
                continue
            run = np.concatenate([[True], after[at[:-1]] != at[1:]])
            place = np.arange(len(at))
            at = at[(place - place[run][np.cumsum(run) - 1]) % 2 == 0]
            gone = after[at]
            sym[at] = self.made[r]
            after[at] = after[gone]
            alive[gone] = False
            linked = at[after[at] >= 0]
            before[after[linked]] = linked
            left = before[at]
            put(np.unique(np.concatenate([at, left[left >= 0]])))
        return sym[alive], word[alive]


def merge_rounds(path: str):
    return Merges(path).segment


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        enc = pretokens.load(tokenizer_path, merge_rounds)
        try:
            for b in batches:
                for row, rows, ids, per in enc.encode(b.column(1)):
                    ends = np.concatenate([[0], np.cumsum(per)]).astype(np.int32) * 4
                    out = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(ids.astype("<u4"))])
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(row, rows), pa.array(per, pa.int64()), out],
                                                     names=["doc_id", "n_tokens", "ids"])
        finally:
            enc.forget()
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


class Pieces:
    """Bytes of every id of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_symbols()
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        raw = []
        for i in range(max(names) + 1):
            t = names.get(i, "")
            known = all(c in alphabet for c in t)
            raw.append(bytes(alphabet[c] for c in t) if known else t.encode())
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray, per: np.ndarray) -> pa.Array:
        known = ids < len(self.size)
        if not known.all():
            per = np.add.reduceat(np.append(known, False).astype(np.int64), np.cumsum(per) - per) * (per > 0)
            ids = ids[known]
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.flat[np.arange(total) + np.repeat(self.start[ids] - (ends - size), size)]
        off = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])].astype(np.int32)
        out = pa.Array.from_buffers(pa.binary(), len(per), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
        try:
            return out.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", errors="replace") for x in out.to_pylist()], pa.string())


def decode(encoded: DataFrame, tokenizer_path: str, *, ids_col: str = "ids") -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of its ids (null: empty)."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    place = encoded.columns.index(ids_col)

    def run(batches):
        pieces = per_worker((tokenizer_path, "pieces"), lambda: Pieces(tokenizer_path))
        for b in batches:
            raw = b.column(place).cast(pa.large_binary())
            sizes = pc.binary_length(raw).fill_null(0).to_numpy(zero_copy_only=False) // 4
            ends, i = np.cumsum(sizes), 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + 500_000, side="right")))
                part = raw.slice(i, j - i)
                ids = np.frombuffer(b"".join(x for x in part.to_pylist() if x), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns), pieces.decode(ids, sizes[i:j])],
                                                 names=[*b.schema.names, "decoded"])
                i = j
    return encoded.mapInArrow(run, schema)
