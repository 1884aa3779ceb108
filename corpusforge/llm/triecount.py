"""Token counts by trie-shared dynamic programming.

A pre-token is a run of non-white-space bytes with the one space before it, or
a run of other white space (ASCII white space).  Under a unigram model its
best segmentation has the highest sum of piece scores, then the fewest tokens.
Pieces and ranks come from a public vocabulary file (never trained here); the
score of rank r is -ln(r + 1) in millionths, so sums are exact.

The distinct pre-tokens of a batch form a trie, walked depth-first (that is
their sorted order): the forward scores along the current path are kept, so a
prefix that several pre-tokens share is computed once, and the count is stored
at each terminal.  A document's count is the sum over its pre-tokens.  Nothing
is shuffled; memory is bounded by the Arrow batch and a fixed number of stored
terminals.

Defined cases: null or empty text has no token; repeated rows and ids are each
counted; null ids come back as null; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import text_bytes

PRETOKEN = re.compile(rb" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+(?![^\x20\x09-\x0D])|[\x20\x09-\x0D]")


def load_scores(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return {p: -round(1e6 * math.log(r + 1)) for p, r in ranks.items()}


def trie_counts(pretokens: list[bytes], scores: dict[bytes, int], longest: int) -> dict[bytes, int]:
    """Tokens of the best segmentation of each distinct pre-token."""
    best, count, out, before = [0], [0], {}, b""
    get = scores.get
    for word in sorted(pretokens):
        shared, top = 0, min(len(word), len(before))
        while shared < top and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for i in range(shared + 1, len(word) + 1):
            top_score, top_count = None, 0
            for j in range(max(0, i - longest), i):
                s = get(word[j:i])
                if s is not None:
                    s += best[j]
                    if top_score is None or s > top_score or (s == top_score and count[j] + 1 < top_count):
                        top_score, top_count = s, count[j] + 1
            best.append(top_score)
            count.append(top_count)
        out[word] = count[-1]
        before = word
    return out


def token_counts(docs: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 stored: int = 500_000) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) per row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        scores = load_scores(vocabulary_path)
        missing = [b for b in range(256) if bytes([b]) not in scores]
        for b in missing:                      # every byte must be a piece
            scores[bytes([b])] = min(scores.values())
        longest = max(map(len, scores))
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = text_bytes(batch, "text")
            for c in range(0, len(texts), 1000):
                if len(known) > stored:
                    known.clear()
                tokens = [PRETOKEN.findall(t) for t in texts[c:c + 1000]]
                known.update(trie_counts(list({t for ts in tokens for t in ts if t not in known}), scores, longest))
                ids = batch.column(0).slice(c, len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(t) for t in tokens], pa.int64()),
                     pa.array([sum(map(known.__getitem__, t)) for t in tokens], pa.int64())],
                    names=["doc_id", "n_pretokens", "n_tokens"])
    return src.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
