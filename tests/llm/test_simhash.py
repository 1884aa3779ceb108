import random
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from corpusforge.llm import simhash as S
from corpusforge.llm.components import connected_components


def slow_fp(text, words=4):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(items, linked):
    up = {i: i for i in items}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_against_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["Über", "the", "of", "É", "x y", "Zed", "k"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(150):
        t = " ".join(rnd.choices(vocab, k=rnd.randrange(0, 400)))
        if rows and rnd.random() < 0.5:
            w = (rnd.choice(rows)[1] or "").split(" ")
            if w:
                w[rnd.randrange(len(w))] = "CHANGED"
            t = "\t".join(w)
        rows.append((i - 10, t if rnd.random() > 0.03 else None))
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, fp string, component int")
    want_fp = {i: slow_fp(t) for i, t in rows}
    want = components([i for i, _ in rows], lambda a, b: bin(want_fp[a] ^ want_fp[b]).count("1") <= 4)
    for block in (4096, 4):
        got = {r.doc_id: r for r in S.simhash_groups(df, block=block).collect()}
        assert {i: int(r.fingerprint, 16) for i, r in got.items()} == want_fp
        assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(rows) - 20


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("some word x y")).alias("h")).first().h % 2 ** 64 == slow_h("some word x y")


def slow_h(s):
    return xxhash.xxh64_intdigest(s.encode(), 42)


def test_search_is_complete_for_every_plan(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for _ in range(4):
            x = b
            for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    want = components(fps, lambda a, b: bin(a ^ b).count("1") <= 4)
    n, co = S.bit_statistics(df)
    assert n == len(fps)
    for m, thr in ((2, [2, 1]), (3, [1, 1, 0]), (3, [2, -1, 1]), (4, [0, 1, 0, 0]), (5, [0] * 5), (6, [0, 0, 0, 0, 0, -1])):
        assert sum(thr) == 4 - m + 1
        edges = S.links(df, 4, parts=S.group_bits(n, co, m), thresholds=thr).collect()
        got = {f: f for f in fps}

        def find(i):
            while got[i] != i:
                i = got[i]
            return i
        for a, b in edges:
            x, y = find(a % 2 ** 64), find(b % 2 ** 64)
            got[max(x, y)] = min(x, y)
        assert {f: find(f) for f in fps} == want


def test_allocation_prefers_probes_when_the_table_is_large():
    co = np.full((64, 64), 0.25) + np.eye(64) * 0.25
    small = S.plan_search(10_000, co * 10_000, 4)
    large = S.plan_search(10 ** 10, co * 10 ** 10, 4)
    assert len(large[0]) < len(small[0])
    for parts, thr in (small, large):
        assert sum(thr) == 4 - len(parts) + 1 and sorted(sum(parts, [])) == list(range(64))


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, None), (None, "a"), (1, ""), (1, ""), (2, "a"), (3, "q r s t u v")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in S.simhash_groups(df).collect())
    a = f"{slow_fp('a'):016x}"
    assert got == sorted([(-1, "0" * 16, -1), (-1, a, -1), (1, "0" * 16, -1), (1, "0" * 16, -1), (2, a, -1),
                          (3, f"{slow_fp('q r s t u v'):016x}", 3)])
    assert S.simhash_groups(df.limit(0)).collect() == []


def test_components_chain_and_star(spark):
    e = [(i, i + 1) for i in range(0, 90)] + [(200, i) for i in range(201, 260)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(e, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(91)) and all(got[i] == 200 for i in range(200, 260))
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def many_ids(n, seed):
    """Rows whose ids are null for a third and repeat for others, with unlike
    texts, near copies and exact copies."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t = " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(150, 250)))
        if rows and rnd.random() < 0.3:
            w = rnd.choice(rows)[1].split(" ")
            w[rnd.randrange(len(w))] = "CHANGED"
            t = " ".join(w)
        rows.append((None if i % 3 == 0 else rnd.randrange(n // 4), t))
        if rnd.random() < 0.1:
            rows.append(rows[-1])
    return rows


def stays(rows):
    """Brute force: of each group of fingerprints the row of smallest (id, crc32)."""
    fps = {t: slow_fp(t) for _, t in rows}
    comp = components(sorted(set(fps.values())), lambda a, b: bin(a ^ b).count("1") <= 4)
    best = {}
    for i, t in rows:
        key = (-1 if i is None else i, zlib.crc32(t.encode()), t)
        g = comp[fps[t]]
        best[g] = min(best.get(g, key), key)
    return sorted((i, t) for i, _, t in best.values())


def test_one_per_group_with_null_and_repeated_ids(spark):
    rows = many_ids(120, 8)
    want = stays(rows)
    assert 5 < sum(i == -1 for i, _ in want) and len(want) < len(set(rows))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string").repartition(5)
    got = S.one_per_group(df).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in got) == want
    assert S.one_per_group(df.limit(0)).collect() == []
