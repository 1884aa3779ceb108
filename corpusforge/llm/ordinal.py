"""Toxicity by cumulative-link ordinal regression.

Features of a text: its lower-cased words (letters) and their prefixes of 4
and 5 letters, each with the value log2(1 + occurrences).  The model is a proportional-odds model: one
weight vector shared by all grades, ordered thresholds, P(y > j) =
sigmoid(x.w - theta_j).  Output: expected severity, most likely grade, the
chance of any toxicity, and ``toxic`` from the score that parts the labelled
rows with the fewest errors.

The label table has one level only, so grades come from it by a rule: a row
labelled clean is grade 0; toxic rows are graded 1..``grades`` by the quantile
of the number of selected features (those associated with toxicity) they hold.

The model is fitted on at most ``max_labelled`` labelled rows (those of least
hash of the id, the same rows on every run) and ``max_features`` features;
both are parameters.  Every document is scored over its whole text.

Defined cases: null and empty texts have no feature and get the base rate;
labels that are null are ignored, a document labelled twice takes the higher
one; repeated ids and rows are each scored; without toxic or clean labels
every document gets severity 0.  All columns are kept, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[str, ...]:
    return (word, "4:" + word[:4], "5:" + word[:5])


def counter(vocab: dict[str, int]):
    """text -> sorted (feature number, value) over the whole text."""
    cache: dict[str, tuple] = {}

    def found(text: str) -> list[tuple[int, float]]:
        if len(cache) > 500_000:
            cache.clear()
        n: Counter = Counter()
        for w in _WORD.findall(text.lower()):
            f = cache.get(w)
            if f is None:
                f = cache[w] = tuple(vocab[x] for x in features(w) if x in vocab)
            if f:
                n.update(f)
        return [(i, math.log2(1 + c)) for i, c in sorted(n.items())]
    return found


@dataclass
class OrdinalModel:
    vocab: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray           # ascending
    cut: float = 0.0                 # score from which a text counts as toxic

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(y > j) per row and threshold."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -60, 60)))

    def scorer(self):
        weights, found = self.weights.tolist(), counter(self.vocab)
        return lambda text: sum(weights[i] * v for i, v in found(text))


def fit_ordinal(rows: list[list[tuple[int, float]]], y: np.ndarray, n_features: int, grades: int, l1: float = 2e-5,
                steps: int = 500, rate: float = 0.1):
    """Proportional odds by proximal Adam: an l1 penalty and weights >= 0 (only
    features that go with toxicity are offered) leave out chance companions;
    thresholds ordered by construction (first, then positive steps)."""
    n, k = len(rows), grades
    ri = np.repeat(np.arange(n), [len(r) for r in rows])
    ci = np.array([i for r in rows for i, _ in r], dtype=np.int64)
    xv = np.array([v for r in rows for _, v in r], dtype=float)
    share = np.array([(y > j).mean() for j in range(k)]).clip(1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(-np.log(share / (1 - share)))
    p = np.concatenate([np.zeros(n_features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    edge = np.arange(n)
    for t in range(1, steps + 1):
        w, th = p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])
        s = np.bincount(ri, weights=w[ci] * xv, minlength=n)
        up = np.ones((n, k + 2))
        up[:, 1:-1] = 1 / (1 + np.exp(-np.clip(s[:, None] - th[None, :], -60, 60)))
        up[:, -1] = 0
        prob = np.maximum(up[edge, y] - up[edge, y + 1], 1e-12)
        d = up * (1 - up)                          # derivative of P(y > j) in the score
        gs = -(d[edge, y] - d[edge, y + 1]) / prob
        gt = np.zeros((n, k + 2))                  # in each threshold
        gt[edge, y] += d[edge, y] / prob
        gt[edge, y + 1] -= d[edge, y + 1] / prob
        gth = gt[:, 1:-1].sum(axis=0)
        g = np.concatenate([np.bincount(ci, weights=gs[ri] * xv, minlength=n_features) / n,
                            [gth.sum() / n], np.exp(p[n_features + 1:]) * gth[::-1].cumsum()[::-1][1:] / n])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        p[:n_features] = np.maximum(p[:n_features] - rate * l1 / (np.sqrt(v[:n_features] / (1 - 0.999 ** t)) + 1e-8), 0)
    th = p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])
    return p[:n_features], th


def best_cut(scores: np.ndarray, toxic: np.ndarray, default: float) -> float:
    """Score between two neighbours with the fewest errors on labelled rows
    (of several: the widest gap)."""
    at = np.unique(scores)
    if len(at) < 2:
        return default
    clean = np.sort(scores[~toxic])
    bad = np.sort(scores[toxic])
    mid = (at[1:] + at[:-1]) / 2
    errors = len(clean) - np.searchsorted(clean, mid) + np.searchsorted(bad, mid)
    least = np.flatnonzero(errors == errors.min())
    return float(mid[least[np.argmax(np.diff(at)[least])]])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          grades: int = 3, max_labelled: int = 20_000, max_features: int = 4_096, min_df: int = 4) -> OrdinalModel:
    lab = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
           .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    sample = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(lab), "id").select("id", "y", "text"))     # at most max_labelled rows

    def count(batches):
        yes, no, n = Counter(), Counter(), [0, 0]
        for b in batches:
            for y, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                f = {x for w in set(_WORD.findall((text or "").lower())) for x in features(w)}
                (yes if y else no).update(f)
                n[1 if y else 0] += 1
        names = ["", *(yes.keys() | no.keys())]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([n[1], *(yes[f] for f in names[1:])], pa.int64()),
                                          pa.array([n[0], *(no[f] for f in names[1:])], pa.int64())], names=["f", "a", "b"])
    df = sample.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    total = df.where("f = ''").first()
    na, nb = (total.a, total.b) if total else (0, 0)
    if not na or not nb:
        return OrdinalModel({}, np.zeros(0), np.full(grades, 60.0), np.inf)
    rate = na / (na + nb)
    n = F.col("a") + F.col("b")
    # likelihood ratio against the base rate, beyond what the number of features brings up by chance
    part = lambda k, r: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (n * r))).otherwise(0.0)
    gain = part("a", rate) + part("b", 1 - rate)
    chosen = (df.where(f"f <> '' and a >= {min_df}").withColumn("g", gain)
              .where((F.col("a") > n * rate) & (F.col("g") > math.log(df.count())))
              .orderBy(F.desc("g"), "f").limit(max_features).collect())
    vocab = {r.f: i for i, r in enumerate(sorted(chosen, key=lambda r: r.f))}

    def encode(batches):
        found = counter(vocab)
        for b in batches:
            x = [found(t or "") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([[i for i, _ in r] for r in x], pa.list_(pa.int32())),
                 pa.array([[v for _, v in r] for r in x], pa.list_(pa.float64()))], names=["id", "y", "x", "v"])
    got = sorted(sample.mapInArrow(encode, "id long, y int, x array<int>, v array<double>").collect(),
                 key=lambda r: (r.id, r.x, r.v))
    rows = [list(zip(r.x, r.v)) for r in got]
    toxic = np.array([r.y > 0 for r in got])
    held = np.array([len(r) for r in rows])
    y = np.zeros(len(rows), np.int64)
    cuts = np.quantile(held[toxic], [i / grades for i in range(1, grades)])
    y[toxic] = 1 + np.searchsorted(cuts, held[toxic], side="left")
    w, th = fit_ordinal(rows, y, len(vocab), grades)
    scores = np.array([sum(w[i] * v for i, v in r) for r in rows])
    return OrdinalModel(vocab, w, th, best_cut(scores, toxic, float(th[0])))


def score(docs: DataFrame, model: OrdinalModel, *, text_col: str = "text") -> DataFrame:
    """(row: struct of all columns, expected_severity, severity, p_toxic, toxic)."""
    src = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)      # at most max_features words and weights

    def run(batches):
        m = shared.value
        fn = m.scorer()
        for b in batches:
            s = np.array([fn(t or "") for t in b.column(1).to_pylist()], dtype=float)
            up = m.above(s)
            each = -np.diff(np.concatenate([np.ones((len(s), 1)), up, np.zeros((len(s), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.round(up.sum(axis=1), 9)), pa.array(each.argmax(axis=1).astype(np.int32)),
                 pa.array(np.round(up[:, 0], 9)), pa.array(s >= m.cut)],
                names=["row", "expected_severity", "severity", "p_toxic", "toxic"])
    kind = src.schema["row"].dataType.simpleString()
    return src.mapInArrow(run, f"row {kind}, expected_severity double, severity int, p_toxic double, toxic boolean")
