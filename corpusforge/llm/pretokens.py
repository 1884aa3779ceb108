"""Whole texts to token ids through their distinct pre-tokens, in numpy.

The byte-level vocabularies cut a text into pre-tokens before any merge:
contractions, letters, digits or other marks with one space before them, and
white space.  ``spans`` finds those cuts for a few megabytes of texts at once
from the class of every code point.  Classes come from the vocabulary's own
library (its Unicode version decides), looked up once for each code point seen.

``Pretokens`` then dictionary-encodes the pre-tokens, asks ``segment`` for the
ids of those not met before, and gathers the ids of all texts in one step.  Its
store of met pre-tokens is bounded and lives as long as the task; the vocabulary
itself, a few megabytes, as long as the Python worker.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

LETTER, DIGIT, SPACE, OTHER, UNKNOWN = 1, 2, 3, 4, 0
CHUNK_BYTES = 2_000_000
STORED = 300_000          # pre-tokens kept between batches
LONG = 64                 # longer pre-tokens are not kept


def per_worker(key, make: Callable):
    """One object per Python worker process, whatever task asks for it."""
    held = vars(sys).setdefault("_corpusforge_models", {})
    if key not in held:
        held[key] = make()
    return held[key]


class Classes:
    """Class of every code point, asked of the library when first met."""

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        self.table = np.zeros(0x110000, np.uint8)

    def __call__(self, cp: np.ndarray) -> np.ndarray:
        k = self.table[cp]
        if not k.all():
            for c in np.unique(cp[k == UNKNOWN]).tolist():
                self.table[c] = self._ask(c)
            k = self.table[cp]
        return k

    def _ask(self, c: int) -> int:
        if 0xD800 <= c < 0xE000:
            return OTHER
        for mate, kind in (("a", LETTER), ("1", DIGIT), ("!", OTHER)):
            if len(self.pre.pre_tokenize_str(mate + chr(c))) == 1:
                return kind
        return SPACE


def code_points(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point, byte position) of UTF-8 bytes."""
    at = np.flatnonzero((b & 0xC0) != 0x80)
    lead = b[at]
    cp = lead.astype(np.uint32)
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        p = np.concatenate([b, np.zeros(3, np.uint8)])
        w, x = at[wide], cp[wide]
        c1, c2, c3 = (p[w + j].astype(np.uint32) & 0x3F for j in (1, 2, 3))
        two = (x & 0x1F) << 6 | c1
        three = (x & 0x0F) << 12 | c1 << 6 | c2
        four = (x & 0x07) << 18 | c1 << 12 | c2 << 6 | c3
        cp[wide] = np.where(x < 0xE0, two, np.where(x < 0xF0, three, four))
    return np.minimum(cp, 0x10FFFF), at


def spans(b: np.ndarray, starts: np.ndarray, classes: Classes, special: re.Pattern | None = None) -> np.ndarray:
    """Byte positions at which a pre-token starts, for texts that start at
    ``starts`` (byte positions) in ``b``."""
    if not len(b):
        return np.zeros(0, np.int64)
    cp, at = code_points(b)
    n = len(cp)
    hard = np.zeros(len(b) + 1, bool)
    hard[starts] = True
    inside = []
    if special is not None:
        raw = b.tobytes()
        for m in special.finditer(raw):
            # a match over a text's border is none
            if not hard[m.start() + 1:m.end()].any():
                hard[m.start()] = hard[m.end()] = True
                inside.append((m.start(), m.end()))
    hard = hard[at]
    k = classes(cp)
    start = hard.copy()
    start[1:] |= k[1:] != k[:-1]
    # the last of several spaces before a word stands alone, or joins it if it is U+0020
    gap = k == SPACE
    last = np.flatnonzero(gap[:-1] & ~gap[1:] & ~hard[1:])
    start[last] = True
    start[last[cp[last] == 32] + 1] = False
    # contractions
    p = np.concatenate([cp, np.zeros(3, np.uint32)])
    h = np.concatenate([hard, np.ones(3, bool)])
    q = np.flatnonzero((cp == 39) & start)
    q = q[~h[q + 1]]
    one = np.isin(p[q + 1], [ord(c) for c in "stmd"])
    a, c = p[q + 1], p[q + 2]
    two = ~h[q + 2] & (((a == ord("r")) & (c == ord("e"))) | ((a == ord("v")) & (c == ord("e"))) |
                       ((a == ord("l")) & (c == ord("l"))))
    for hit, size in ((q[one], 1), (q[two & ~one], 2)):
        start[hit + 1] = False
        end = hit + 1 + size
        start[end[end < n]] = True
    first = at[start]
    if inside:
        keep = np.ones(len(first), bool)
        for s, e in inside:
            lo, hi = np.searchsorted(first, [s + 1, e])
            keep[lo:hi] = False
        first = first[keep]
    return first


def windows(b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Cuts of one text before a space that follows an ASCII letter or digit:
    always the start of a pre-token."""
    cuts, s = [], 0
    while len(b) - s > size:
        p = s + size
        found = -1
        while p < len(b) and found < 0:
            part, before = b[p:p + 65_536], b[p - 1:p + 65_535]
            alnum = ((before | 32) >= 97) & ((before | 32) <= 122) | (before >= 48) & (before <= 57)
            hit = np.flatnonzero((part == 32) & alnum[:len(part)])
            found = p + int(hit[0]) if len(hit) else -1
            p += 65_536
        if found < 0:
            break
        cuts.append((s, found))
        s = found
    cuts.append((s, len(b)))
    return cuts


class Pretokens:
    """Ids of whole texts.  ``segment(words)`` gives (flat ids, ids per word)."""

    def __init__(self, path: str, segment: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], pre_tokenizer):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only plain byte-level vocabularies")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added):
            raise ValueError("added tokens with white space or word rules are not supported")
        self.added = {t["content"].encode(): t["id"] for t in added}
        self.special = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        self.segment, self.classes = segment, Classes(pre_tokenizer)
        self.forget()

    def forget(self):
        """Let go of the pre-tokens met so far (at the end of a task: a worker
        lives on, and later tasks need its memory)."""
        self.place: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        for n, (word, i) in enumerate(self.added.items()):
            self.place[word] = self._store(np.array([i], np.uint32), np.ones(1, np.int64), n)[0]

    def _store(self, flat: np.ndarray, sizes: np.ndarray, n0: int) -> range:
        """Store the ids of words numbered from ``n0``."""
        n1 = n0 + len(sizes)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n1 > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used:self.used + len(flat)] = flat
        self.start[n0:n1] = self.used + np.cumsum(sizes) - sizes
        self.size[n0:n1] = sizes
        self.used += len(flat)
        return range(n0, n1)

    def chunk(self, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text) of texts at ``starts`` in the bytes ``b``."""
        first = spans(b, starts, self.classes, self.special)
        if not len(first):
            return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        offsets = np.append(first, len(b)).astype(np.int32)
        tokens = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(b)])
        enc = tokens.dictionary_encode()
        words = enc.dictionary.to_pylist()
        if len(self.place) > STORED:
            self.forget()
        place = self.place
        number = [place.get(w, -1) for w in words]
        new = [i for i, x in enumerate(number) if x < 0]
        kept = [i for i in new if len(words[i]) <= LONG]
        for i, x in zip(kept, self._store(*self.segment([words[i] for i in kept]), len(place))):
            number[i] = place[words[i]] = x
        rest = [i for i in new if number[i] < 0]          # long ones: for this chunk only
        mark = self.used
        for i, x in zip(rest, self._store(*self.segment([words[i] for i in rest]), len(place))):
            number[i] = x
        which = np.asarray(number, np.int64)[enc.indices.to_numpy(zero_copy_only=False)]
        size = self.size[which]
        ends = np.cumsum(size)
        gather = np.arange(int(ends[-1])) + np.repeat(self.start[which] - (ends - size), size)
        ids = self.flat[gather]
        self.used = mark
        per_text = np.diff(np.append(np.concatenate([[0], ends])[np.searchsorted(first, starts)], ends[-1]))
        return ids, per_text

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Texts of a string column (null: empty) in chunks of rows:
        (first row, rows, ids, ids per row)."""
        col = column.cast(pa.large_binary())
        if col.null_count:
            col = col.fill_null(b"")
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, side="right")) - 1)
            b = np.ascontiguousarray(data[off[i]:off[j]])
            if j == i + 1 and len(b) > 2 * CHUNK_BYTES:
                parts = [self.chunk(np.ascontiguousarray(b[s:e]), np.zeros(1, np.int64))[0] for s, e in windows(b, CHUNK_BYTES)]
                ids = np.concatenate(parts)
                yield i, 1, ids, np.array([len(ids)])
            else:
                ids, per = self.chunk(b, (off[i:j] - off[i]).astype(np.int64))
                yield i, j - i, ids, per
            i = j


def load(path: str, segmenter: Callable) -> Pretokens:
    """The encoder of this worker for a vocabulary file; ``segmenter(path)`` makes
    its ``segment`` function."""
    from tokenizers import Tokenizer

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Pretokens(path, segmenter(path), Tokenizer.from_file(path).pre_tokenizer)
    return per_worker((path, segmenter.__name__), make)
