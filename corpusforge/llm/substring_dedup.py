"""Substring dedup by suffix automata (words).

A window is ``length`` consecutive words of one document.  Every word under a
window whose word sequence also starts earlier (smaller id, or same document
and earlier start) is removed; windows are judged on the input.

The reference here is the corpus itself, so its suffix automata can not be
broadcast whole: `repeats` routes the candidate passages by a content-defined
anchor, and each shard of at most ``rows_per_shard`` passages builds the
suffix automaton of its earlier passages and streams each passage through it
for matching statistics.  Positions whose statistic reaches ``length`` end a
window that starts earlier; maximal runs of them are the removed spans.  An
automaton therefore only ever lives in the task of its shard, with a fixed
size bound, and no document meets an automaton that it shares no anchor with.

Defined cases: null or blank text has no words (n_words 0, hash of the empty
string); null ids sort first; repeated rows and repeated ids as in `repeats`;
other columns are ignored, whatever their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from corpusforge.llm.common import id_out
from corpusforge.llm.repeats import removal_mask, repeated_spans, with_spans


class SuffixAutomaton:
    """Generalised suffix automaton over integer symbols."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.len = [0]

    def _clone(self, p: int, c, q: int) -> int:
        r = len(self.len)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = r
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = r
            p = self.link[p]
        return r

    def add(self, symbols) -> None:
        last = 0
        for c in symbols:
            q = self.next[last].get(c)
            if q is not None:                                  # known already
                last = q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
                continue
            cur = len(self.len)
            self.next.append({})
            self.link.append(0)
            self.len.append(self.len[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
            last = cur

    def matching(self, symbols) -> list[int]:
        """Longest suffix of each prefix of ``symbols`` that occurs in the automaton."""
        nxt, link, ln = self.next, self.link, self.len
        state, n, out = 0, 0, []
        for c in symbols:
            while state and c not in nxt[state]:
                state = link[state]
                n = ln[state]
            to = nxt[state].get(c)
            if to is None:
                n = 0
            else:
                state, n = to, n + 1
            out.append(n)
        return out


def matching_solver(group, place, pieces, length):
    """Passages in order of position: matching statistics against the
    automaton of all earlier ones, then added to it."""
    shard = SuffixAutomaton()
    out: list = [None] * len(pieces)
    for i in np.argsort(place):
        symbols = np.frombuffer(pieces[i], dtype=np.uint64).tolist()
        stats = shard.matching(symbols)
        out[i] = np.array(stats[length - 1:]) >= length
        shard.add(symbols)
    return out


def _kept(text: bytes, spans) -> tuple:
    words = text.split()
    if spans:
        gone = removal_mask(len(words), spans)
        kept = b" ".join([w for w, g in zip(words, gone) if not g])
        return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()
    kept = b" ".join(words)
    return len(words), 0, hashlib.sha256(kept).hexdigest(), kept.decode()


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 20, k: int = 6,
                    rows_per_shard: int = 1024, block: int = 1024, hot_rows: int = 1_000_000, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) per input row."""
    spans = repeated_spans(docs, id_col, text_col, symbols="words", length=length, k=k, solve=matching_solver,
                           block=block, rows_per_shard=rows_per_shard, hot_rows=hot_rows)
    fn = _kept if with_text else (lambda t, s: _kept(t, s)[:3])
    schema = "n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    out = with_spans(docs, spans, id_col, text_col, fn, schema)
    return out.withColumn("doc_id", id_out("doc_id"))
