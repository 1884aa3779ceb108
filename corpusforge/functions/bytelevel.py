"""Byte-level alphabet and the per-word BPE helper.

The printable byte alphabet is the published GPT-2 rule: bytes that are
printable Latin-1 map to themselves, every other byte to the next free code
point from 256 up.  The table is generated from that rule.
"""

from __future__ import annotations

import heapq

import numpy as np

# Fixed value: the published GPT-2 pre-tokenisation pattern (Java regex with
# UNICODE_CHARACTER_CLASS, so \s is Unicode whitespace as in Python's `regex`).
GPT2_PATTERN = (r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """``chars[b]`` is the printable stand-in of byte ``b``."""
    keep = set(range(ord("!"), ord("~") + 1)) | set(range(0xA1, 0xAC + 1)) | set(range(0xAE, 0xFF + 1))
    chars, extra = [], 0
    for b in range(256):
        if b in keep:
            chars.append(chr(b))
        else:
            chars.append(chr(256 + extra))
            extra += 1
    return chars


BYTE_CHARS = byte_alphabet()
CHAR_BYTES = {c: b for b, c in enumerate(BYTE_CHARS)}
_TRANSLATE = {i: c for i, c in enumerate(BYTE_CHARS)}


def to_symbols(word: str) -> str:
    """UTF-8 bytes of ``word`` as byte-alphabet characters."""
    return word.encode("utf-8").decode("latin-1").translate(_TRANSLATE)


def from_symbols(text: str) -> bytes:
    """Inverse of :func:`to_symbols` (characters outside the alphabet dropped)."""
    return bytes(CHAR_BYTES[c] for c in text if c in CHAR_BYTES)


#: words of more symbols go through ``segment_long``
LONG_WORD = 40


def segment_long(symbols: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """``bpe_segment`` in O(n log n): a linked list of symbols and a heap of
    (rank, place).  All places of the lowest rank are merged from left to right
    before the next rank; a place whose pair has changed meanwhile is skipped."""
    sym: list[str | None] = list(symbols)
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, places = heap[0][0], []
        while heap and heap[0][0] == rank:
            places.append(heapq.heappop(heap)[1])
        for i in places:
            j = after[i]
            if sym[i] is None or j >= n or ranks.get((sym[i], sym[j])) != rank:
                continue
            sym[i], sym[j] = sym[i] + sym[j], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            h = before[i]
            for a, b in ((h, i), (i, k)):
                if a >= 0 and b < n:
                    r = ranks.get((sym[a], sym[b]))
                    if r is not None:
                        heapq.heappush(heap, (r, a))
    return [s for s in sym if s is not None]


def bpe_segment(symbols: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply merges by rank inside one word: repeatedly merge the adjacent
    pair of lowest rank (all its non-overlapping occurrences, left to right)."""
    if len(symbols) > LONG_WORD:
        return segment_long(symbols, ranks)
    parts = list(symbols)
    while len(parts) > 1:
        best, best_rank = None, None
        for i in range(len(parts) - 1):
            r = ranks.get((parts[i], parts[i + 1]))
            if r is not None and (best_rank is None or r < best_rank):
                best, best_rank = (parts[i], parts[i + 1]), r
        if best is None:
            break
        merged, i, out = best[0] + best[1], 0, []
        while i < len(parts):
            if i < len(parts) - 1 and parts[i] == best[0] and parts[i + 1] == best[1]:
                out.append(merged)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


#: up to so many symbols, merges are looked up in a table of all their pairs
FEW_SYMBOLS = 1024


class MergeTable:
    """Merge ranks over numbered symbols, to segment many words at once; bytes
    are the symbols 0 to 255."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        number = {c: b for b, c in enumerate(BYTE_CHARS)}
        rows = []
        for (left, right), rank in ranks.items():
            ids = [number.setdefault(s, len(number)) for s in (left, right, left + right)]
            rows.append((ids[0] << 32 | ids[1], rank, ids[2]))
        rows.sort()
        self.names = list(number)
        self.keys, self.rank, self.made = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        # few symbols: the place of every pair of symbols among the keys
        self.pairs = None
        if len(number) <= FEW_SYMBOLS:
            self.pairs = np.full((len(number), len(number)), len(rows), np.int32)
            self.pairs[self.keys >> 32, self.keys & 0xFFFFFFFF] = np.arange(len(rows))
            self.pairs = self.pairs.ravel()

    def _places(self, syms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key's place of every two symbols side by side, and whether there is one."""
        if self.pairs is not None:
            at = self.pairs[syms[:-1] * len(self.names) + syms[1:]]
            return np.minimum(at, len(self.keys) - 1), at < len(self.keys)
        key = syms[:-1] << 32 | syms[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words, one word after the other, and their number in
        each: ``bpe_segment`` of every word, a merge of each word at a time."""
        return self.segment_bytes(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))

    def segment_bytes(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` of words that lie one after the other in ``data``."""
        syms = data.astype(np.int64)
        place = np.arange(len(size))
        words = place
        none, done = np.iinfo(np.int64).max, []
        while len(self.keys) and len(syms):
            word = np.repeat(np.arange(len(size)), size)
            at, known = self._places(syms)
            rank = np.append(np.where(known & (word[:-1] == word[1:]), self.rank[at], none), none)
            best = np.full(len(size), none)
            some = size > 0
            best[some] = np.minimum.reduceat(rank, (np.cumsum(size) - size)[some])
            go = best < none
            on = go[word]
            done.append((place[~go], size[~go], syms[~on]))
            hit = np.flatnonzero(on & (rank == best[word]))
            if not len(hit):
                syms, size, place = syms[on], size[go], place[go]
                break
            # places overlap only in a run of one symbol (a a a): every second one
            run = np.concatenate([[True], np.diff(hit) != 1])
            hit = hit[(hit - hit[run][np.cumsum(run) - 1]) % 2 == 0]
            syms = syms.copy()
            syms[hit] = self.made[at[hit]]
            on[hit + 1] = False
            syms, size, place = syms[on], np.bincount(word[on], minlength=len(size))[go], place[go]
        done.append((place, size, syms))
        place, size, syms = (np.concatenate([d[i] for d in done]) for i in range(3))
        lens = np.zeros(len(words), np.int64)
        lens[place] = size
        start, target = np.cumsum(size) - size, np.cumsum(lens) - lens
        out = np.zeros(len(syms), np.int64)
        out[np.repeat(target[place] - start, size) + np.arange(len(syms))] = syms
        return out, lens
