import math

import pytest

from corpusforge.operators import candidates as N

ROWS = [("c", "a", 5.0), ("c", "b", 3.0), ("c", "d", 3.0), ("c", "e", 1.0),
        ("h", "x", 1.0), ("h", "y", 1.0), ("h", "z", 1.0), ("s", "q", 2.0)]


def cands(spark):
    return spark.createDataFrame(ROWS, "context_id string, item_id string, score double")


def brute_rank_keep(k):
    out = set()
    for ctx in {r[0] for r in ROWS}:
        items = [r for r in ROWS if r[0] == ctx]
        for r in items:
            if sum(1 for o in items if o[2] > r[2]) < k:
                out.add((r[0], r[1]))
    return out


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_top_k_with_ties_is_rank_le_k(spark, k):
    got = N.top_k_with_ties(cands(spark), k, salts=3).collect()
    assert {(r.context_id, r.item_id) for r in got} == brute_rank_keep(k)
    for ctx in {r.context_id for r in got}:
        assert abs(sum(r.prob for r in got if r.context_id == ctx) - 1.0) < 1e-12


@pytest.mark.parametrize("k", [1, 2, 3, 10])
def test_exact_top_k(spark, k):
    got = N.top_k_exact(cands(spark), k, salts=3).collect()
    for ctx in {r[0] for r in ROWS}:
        items = sorted((r for r in ROWS if r[0] == ctx), key=lambda r: (-r[2], r[1]))[:k]
        mine = sorted((r for r in got if r.context_id == ctx), key=lambda r: r.rank_in_context)
        assert [r.item_id for r in mine] == [r[1] for r in items]


def test_softmax_and_nucleus(spark):
    p = {(r.context_id, r.item_id): r.prob for r in N.softmax(cands(spark), 1.0).collect()}
    z = math.exp(5) + 2 * math.exp(3) + math.exp(1)
    assert abs(p[("c", "a")] - math.exp(5) / z) < 1e-12
    nuc = N.nucleus(cands(spark), k=100, top_p=0.5).collect()
    # first item of c already exceeds p: kept alone
    assert sorted(r.item_id for r in nuc if r.context_id == "c") == ["a"]
    assert sorted(r.item_id for r in nuc if r.context_id == "h") == ["x"]
    nuc9 = N.nucleus(cands(spark), k=100, top_p=0.9).collect()
    # running sums 0.776, 0.881, 0.986: the item crossing 0.9 is dropped
    assert sorted(r.item_id for r in nuc9 if r.context_id == "c") == ["a", "b"]


def test_draw_and_array_rules(spark):
    d = N.weighted_draw(N.softmax(cands(spark)), seed=1).collect()
    assert {r.context_id for r in d} == {"c", "h", "s"}
    df = spark.createDataFrame([([5, 3, 7, 3],), ([1, 2],)], "ids array<int>")
    got = df.select(N.cut_at_eos("ids", 3).alias("a"), N.keep_last("ids", 3).alias("b")).collect()
    assert list(got[0].a) == [5] and list(got[1].a) == [1, 2]
    assert list(got[0].b) == [3, 7, 3] and list(got[1].b) == [1, 2]


def test_bigram_candidates(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b"],), (["a"],), ([],)], "words array<string>")
    got = {(r.context_id, r.item_id): r.score for r in N.bigram_candidates(df).collect()}
    assert got == {("a", "b"): 2.0, ("b", "a"): 1.0}


def test_hot_context_is_spread(spark):
    """A context with a third of all rows: same result, many tasks in the join."""
    from pyspark.sql import functions as F

    from corpusforge.operators.skew import hot_keys, join_hot

    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("context_id"),
        F.col("id").alias("item_id"), ((F.col("id") * 7) % 11).cast("double").alias("score"))
    counts = df.groupBy("context_id").agg(F.count("*").alias("n"), F.max("score").alias("top"))
    hot = hot_keys(counts, "context_id", "n", min_rows=100)
    assert [r.context_id for r in hot.collect()] == [-1]
    got = join_hot(df, counts.select("context_id", "top"), "context_id", hot, F.col("item_id"))
    assert got.count() == 60_000
    # a table too large to broadcast, partitions not merged for being small
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parts = got.where("context_id = -1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(parts) > 2 and max(r["count"] for r in parts) < 15_000
    plain = df.join(counts.select("context_id", "top"), "context_id")
    assert got.exceptAll(plain.select(got.columns)).count() == 0


def test_null_context_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a", 1.0), ("c", "a", 1.0)], "context_id string, item_id string, score double")
    assert [r.context_id for r in N.softmax(df).collect()] == ["c"]
    assert N.softmax(df.where("false")).count() == 0


def test_softmax_of_far_apart_scores(spark):
    """Steps of the sum: scores from -1000 to 1000, equal ones, single ones."""
    import math

    rows = [("a", str(i), float(x)) for i, x in enumerate([-1000, -40, -32, -31.5, 0, 0, 31.9, 32, 33, 900, 1000, 999.5])]
    rows += [("b", "0", -5000.0), ("c", "0", 3.0), ("c", "1", 3.0)]
    df = spark.createDataFrame(rows, "context_id string, item_id string, score double")
    for t in (1.0, 0.3, 50.0):
        got = {(r.context_id, r.item_id): r.prob for r in N.softmax(df, t).collect()}
        for c in "abc":
            mine = [(i, s / t) for k, i, s in rows if k == c]
            top = max(s for _, s in mine)
            z = math.fsum(math.exp(s - top) for _, s in mine)
            for i, s in mine:
                assert math.isclose(got[c, i], math.exp(s - top) / z, rel_tol=1e-9, abs_tol=1e-300)


def test_top_k_with_ties_against_rank(spark):
    import math
    import random

    r = random.Random(2)
    rows = [(r.choice("xyz"), str(i), float(r.randrange(6))) for i in range(200)] + [("w", "0", 1.0), ("v", "0", None), ("v", "1", 2.0)]
    df = spark.createDataFrame(rows, "context_id string, item_id string, score double")
    for k in (1, 3, 60, 500):
        got = {(x.context_id, x.item_id): x.prob for x in N.top_k_with_ties(df, k, 0.5).collect()}
        want = {}
        for c in "xyzwv":
            mine = sorted(((s, i) for cc, i, s in rows if cc == c and s is not None), reverse=True)
            kth = mine[min(k, len(mine)) - 1][0]
            keep = [(s, i) for s, i in mine if s >= kth]
            z = sum(math.exp((s - mine[0][0]) / 0.5) for s, _ in keep)
            want |= {(c, i): math.exp((s - mine[0][0]) / 0.5) / z for s, i in keep}
        assert got.keys() == want.keys() and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)
