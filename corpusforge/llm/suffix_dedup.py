"""Suffix-array dedup by deep-shallow sorting (bytes).

Texts are UTF-8 bytes.  Every byte under a ``length``-byte string that also
starts earlier (smaller id, or same document and earlier start) is removed;
overlaps count, matches never cross documents, strings are judged on the
input.

`repeats` brings together the passages that share a content-defined anchor.
Their suffixes (cut at ``length`` bytes, beyond which their order does not
matter here) are sorted in two ways: multikey quicksort steps of eight bytes a
key down to a shallow depth, each refining only groups that are still tied;
then a blind trie per remaining deep group, which compares one branching byte
a level on the way down and the text once at the leaf.  Suffixes that end in
the same leaf are equal; all but the earliest are covered.

Defined cases: null text is empty; null ids sort first; repeated rows and ids
as in `repeats`; other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import id_out
from corpusforge.llm.repeats import removal_mask, repeated_spans, with_spans

SHALLOW = 32


def shallow_sort(buf: np.ndarray, at: np.ndarray, tie: np.ndarray, depth: int):
    """Multikey refinement: order suffixes ``at`` inside equal ``tie`` by their
    first ``depth`` bytes, eight bytes a step, only where still tied.
    Returns (row order, class of each ordered row)."""
    order = np.argsort(tie, kind="stable")
    cls = np.cumsum(np.concatenate([[0], (np.diff(tie[order]) != 0).astype(np.int64)])) if len(order) else order
    for d in range(0, depth, 8):
        same = np.zeros(len(order), bool)
        eq = cls[1:] == cls[:-1]
        same[1:] |= eq
        same[:-1] |= eq
        live = np.flatnonzero(same)
        if not len(live):
            break
        pos = at[order[live]] + d
        key = np.zeros(len(live), dtype=np.uint64)
        for j in range(min(8, depth - d)):
            key = (key << np.uint64(8)) | buf[pos + j]
        by = np.lexsort((key, cls[live]))
        order[live] = order[live][by]
        key = key[by]
        new = np.zeros(len(order), dtype=np.int64)
        new[1:] = cls[1:] != cls[:-1]
        inner = (key[1:] != key[:-1]) & (np.diff(live) == 1)
        new[live[1:][inner]] = 1
        cls = np.cumsum(new)
    return order, cls


class BlindTrie:
    """Patricia trie over strings of one length: inner nodes keep the depth of
    their branching byte, leaves the first string and all members."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def insert(self, s: bytes, member) -> object | None:
        """Add; returns the first member with an equal string, or None."""
        if self.root is None:
            self.root = (s, [member])
            return None
        node = self.root
        while isinstance(node, list):                # blind: no text compared on the way
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        if node[0] == s:
            node[1].append(member)
            return node[1][0]
        t = node[0]
        x = int.from_bytes(s, "big") ^ int.from_bytes(t, "big")
        d = len(s) - (x.bit_length() + 7) // 8       # first byte that differs
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < d:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == d:
            node[1][s[d]] = (s, [member])
            return None
        inner = [d, {t[d]: node, s[d]: (s, [member])}]
        if parent is None:
            self.root = inner
        else:
            parent[1][s[parent[0]]] = inner
        return None

    def __iter__(self):
        """Leaves in suffix order: (string, members)."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                yield node


def deep_shallow_solver(group, place, pieces, length):
    data = b"".join(pieces)
    buf = np.frombuffer(data, dtype=np.uint8)
    lens = np.array([len(p) for p in pieces])
    begin = np.cumsum(lens) - lens
    windows = lens - length + 1
    owner = np.repeat(np.arange(len(pieces)), windows)
    first = np.cumsum(windows) - windows
    at = begin[owner] + (np.arange(len(owner)) - first[owner])
    # earliest first inside a tie: rows enter in order of position
    by_place = np.lexsort((at, place[owner]))
    at, owner = at[by_place], owner[by_place]
    shallow = min(SHALLOW, length)
    order, cls = shallow_sort(buf, at, group[owner], shallow)
    hit = np.zeros(len(buf) + 1, dtype=bool)
    bounds = np.flatnonzero(np.diff(np.concatenate([[-1], cls, [-2]])))
    sizes = np.diff(bounds)
    for b, n in zip(bounds[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        rows = np.sort(order[b:b + n])
        trie = BlindTrie()
        for r in rows.tolist():
            a = int(at[r])
            if trie.insert(data[a + shallow:a + length], a) is not None:
                hit[a] = True
    return [hit[b:b + w].copy() for b, w in zip(begin.tolist(), windows.tolist())]


def _digest(text: bytes, spans) -> tuple:
    if not spans:
        return len(text), 0, 0, hashlib.sha256(text).hexdigest()
    gone = removal_mask(len(text), spans)
    runs = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def _kept_text(text: bytes, spans) -> tuple:
    """The kept text as a string: a character stays if any of its bytes stays."""
    if not spans:
        return (*_digest(text, spans), text.decode())
    gone = removal_mask(len(text), spans)
    b = np.frombuffer(text, np.uint8)
    char = np.cumsum((b & 0xC0) != 0x80) - 1
    stays = np.zeros(int(char[-1]) + 1, bool)
    stays[char[~gone]] = True
    return (*_digest(text, spans), b[stays[char]].tobytes().decode())


def suffix_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, k: int = 24,
                 rows_per_shard: int = 4096, block: int = 2048, hot_rows: int = 1_000_000, with_text: bool = False,
                 carry: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept_text][, carry]) per input row.
    ``kept_text`` keeps a whole character if any byte of it is kept, so that it is valid text."""
    spans = repeated_spans(docs, id_col, text_col, symbols="bytes", length=length, k=k, solve=deep_shallow_solver,
                           block=block, rows_per_shard=rows_per_shard, hot_rows=hot_rows)
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if with_text else "")
    out = with_spans(docs, spans, id_col, text_col, _kept_text if with_text else _digest, schema, carry)
    return out.withColumn("doc_id", id_out(F.col("doc_id")))
