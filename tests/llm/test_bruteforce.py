"""Operators against plain versions of their methods."""
import random

import numpy as np
import pytest

from corpusforge.llm import packing, tiling


def naive_tiles(p, t, least):
    """Greedy string tiling by comparing everywhere."""
    mp, mt, out = [False] * len(p), [False] * len(t), 0
    for size in range(min(len(p), len(t)), least - 1, -1):
        for j in range(len(t) - size + 1):
            for i in range(len(p) - size + 1):
                if p[i:i + size] == t[j:j + size] and not any(mp[i:i + size]) and not any(mt[j:j + size]):
                    mp[i:i + size] = mt[j:j + size] = [True] * size
                    out += size
    return out


@pytest.mark.parametrize("least,shard", [(3, 8_000_000), (3, 60), (5, 200)])
def test_decontamination_against_naive_tiling(spark, least, shard):
    r = random.Random(least + shard)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([2, 6, 12, 20])))) for i in range(14)] + [(None, "a b c d e f g"), (3, "")]
    docs = []
    for i in range(60):
        t = r.choices(vocab, k=r.randrange(0, 40))
        for _ in range(r.choice([0, 1, 2])):
            w = r.choice(items)[1].split()
            s = r.randrange(0, max(1, len(w) - 4))
            at = r.randrange(0, len(t) + 1)
            t[at:at] = w[s:s + r.randrange(3, 15)]
        docs.append((i, " ".join(t).upper()))
    docs += [(None, None), (0, docs[0][1]), (70, " ".join(r.choices(vocab, k=30_000)) + " " + items[3][1])]
    df = spark.createDataFrame([(i, t, "row") for i, t in docs], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = tiling.decontaminate(df, bench, min_match=least, threshold=0.5, shard_bytes=shard).collect()
    assert len(got) == len(docs)
    for x in got:
        if x.row.doc_id == 70:
            continue                                    # too long for the naive way; checked below
        want = set()
        for i, t in items:
            w = tiling.words(t)
            if len(w) >= least:
                c = naive_tiles(w, tiling.words(x.row.text), least) / len(w)
                if c >= 0.5:
                    want.add((i, round(c, 9)))
        assert {(h.item_id, round(h.coverage, 9)) for h in x.hits} == want
    long, = [x for x in got if x.row.doc_id == 70]
    if len(items[3][1].split()) >= least:
        assert items[3][0] in {h.item_id for h in long.hits}


def sequential(lengths, capacity, docs, attention, weights, rule):
    """Vector best fit, one piece at a time, longest first: residuals of all sequences."""
    cap, w, bins = np.array([capacity, docs, attention], float), np.asarray(weights, float), []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, float(n) ** 2])
        best = None
        for k, res in enumerate(bins):
            if (res >= need).all():
                r = res / cap
                score = (-(w * (r - need / cap) ** 2).sum() if rule == "norm"
                         else (w * r * (need / cap)).sum() / np.sqrt((w * r * r).sum() + 1e-12))
                if best is None or score > best[0] + 1e-12:
                    best = (score, k)
        if best is None:
            bins.append(cap - need)
        else:
            bins[best[1]] = bins[best[1]] - need
    return bins


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("docs,attention", [(1000, 1e9), (3, 1e9), (1000, 900.0), (4, 1300.0)])
def test_plan_equals_sequential_vector_best_fit(rule, docs, attention):
    for seed in range(12):
        r = random.Random(seed)
        lengths = [r.choice([1, 2, 3, 5, 8, 13, 20, 27]) for _ in range(r.randrange(1, 120))]
        hist = {n: lengths.count(n) for n in set(lengths)}
        weights = (1.0, 0.05, 0.02)
        runs = packing.best_fit_plan(hist, 40, docs, attention, weights, rule)
        placed = {}
        for n, _, count, first, offset in runs:
            for s in range(first, first + count):
                placed.setdefault(s, []).append((offset, n))
        assert sum(len(x) for x in placed.values()) == len(lengths)
        for x in placed.values():
            at = 0
            for offset, n in sorted(x):
                assert offset == at
                at += n
            assert at <= 40 and len(x) <= docs and sum(n * n for _, n in x) <= attention
        want = sequential(lengths, 40, docs, attention, weights, rule)
        assert len(placed) == len(want)
