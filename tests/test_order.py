import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusforge.operators import order
from conftest import docs


def naive_positions(df, seed=42):
    k = df.withColumn("k", order.order_key(seed, "doc_id"))
    return {r.doc_id: r.p for r in k.select("doc_id", (F.row_number().over(Window.orderBy("k", "doc_id")) - 1)
                                            .alias("p")).collect()}


def test_positions_match_single_window(spark):
    d = docs(spark).select("doc_id")
    got = {r.doc_id: r.pos for r in order.shuffle_positions(d, "doc_id", 42).collect()}
    assert got == naive_positions(d)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_positions_invariant_under_repartition(spark, parts):
    d = docs(spark).select("doc_id")
    base = {r.doc_id: r.pos for r in order.shuffle_positions(d, "doc_id", 42, digits=2).collect()}
    again = {r.doc_id: r.pos for r in order.shuffle_positions(d.repartition(parts), "doc_id", 42, digits=2).collect()}
    assert base == again


def test_running_sums_match_python(spark):
    d = docs(spark).select("doc_id", "n_chars")
    out = order.shuffle_positions(d, "doc_id", 7, sums={"c": F.col("n_chars")}, digits=2).collect()
    rows = sorted(out, key=lambda r: r.pos)
    acc = 0
    for r in rows:
        assert r.c_offset == acc
        acc += r.n_chars
    assert all(r.c_total == acc for r in rows)


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 99, 100, 101])
@pytest.mark.parametrize("ratio", [0.01, 0.1])
def test_tail_split_exact_sizes(spark, n, ratio):
    d = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = order.tail_split(d, "doc_id", ratio, 42).collect()
    val = [r for r in rows if r.split == "validation"]
    assert len(rows) == n
    assert len(val) == int(n * ratio)
    assert sorted(r.pos for r in rows) == list(range(n))
    # validation is the tail of the permutation
    assert all(r.pos >= n - int(n * ratio) for r in val)


@pytest.mark.parametrize("n", [0, 1, 10, 101])
def test_head_split_and_prefix(spark, n):
    d = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = order.head_split(d, "doc_id", 0.1).collect()
    val = sorted(r.doc_id for r in rows if r.split == "validation")
    assert val == list(range(int(n * 0.1)))
    assert sorted(r.doc_id for r in order.prefix_n(d, "doc_id", 5).collect()) == list(range(min(5, n)))


def test_fraction_and_n_samples(spark):
    d = spark.range(101).withColumnRenamed("id", "doc_id")
    assert order.exact_fraction_sample(d, "doc_id", 0.25).count() == 25
    assert order.exact_n_sample(d, "doc_id", 500).count() == 101
    a = {r.doc_id for r in order.exact_n_sample(d, "doc_id", 30, seed=1).collect()}
    b = {r.doc_id for r in order.exact_n_sample(d, "doc_id", 30, seed=2).collect()}
    assert len(a) == len(b) == 30 and a != b


def test_batch_plan_reshuffles_and_drops_last(spark):
    d = spark.range(37).withColumnRenamed("id", "doc_id")
    plan = order.batch_plan(d, "doc_id", epochs=2, batch_size=8, drop_last=True).collect()
    for e in (0, 1):
        rows = [r for r in plan if r.epoch == e]
        assert len(rows) == 32 and max(r.batch_id for r in rows) == 3
    e0 = {r.doc_id: r.pos for r in plan if r.epoch == 0}
    e1 = {r.doc_id: r.pos for r in plan if r.epoch == 1}
    assert e0 != e1
    steps = order.step_counts(order.batch_plan(d, "doc_id", 1, 8), grad_accum=2).collect()[0]
    assert steps.n_batches == 5 and steps.n_steps == 2


def test_pool_keeps_duplicates(spark):
    a = spark.createDataFrame([("x",), ("y",)], "text string")
    assert order.pool(a, a).count() == 4


def test_quantile_buckets_balance_clustered_ids(spark):
    # ids clustered in a narrow range plus a long sparse tail
    ids = list(range(1000)) + [10 ** 9 + i * 10 ** 6 for i in range(50)]
    d = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    b = order.quantile_buckets(d, "doc_id", 4)
    sizes = sorted(r["count"] for r in b.groupBy("_qbucket").count().collect())
    assert len(sizes) == 4 and max(sizes) <= 2 * min(sizes)
    got = order.input_positions(d, "doc_id").collect()
    assert sorted((r.doc_id, r.pos) for r in got) == [(v, i) for i, v in enumerate(sorted(ids))]


def test_batch_plan_in_order_for_validation(spark):
    d = spark.createDataFrame([(i * 3,) for i in range(20)], "doc_id long")
    plan = order.batch_plan(d, "doc_id", epochs=2, batch_size=6, shuffle=False).collect()
    for e in (0, 1):
        rows = sorted((r for r in plan if r.epoch == e), key=lambda r: r.doc_id)
        assert [r.pos for r in rows] == list(range(20))
        assert [r.batch_id for r in rows] == [i // 6 for i in range(20)]


def test_keyed_permutation_is_a_bijection(spark):
    import random

    r = random.Random(1)
    sizes = [*range(1, 200), *(r.randrange(200, 5001) for _ in range(30)), 5000]
    rows = spark.createDataFrame([(n,) for n in sorted(set(sizes))], "n long").withColumn(
        "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    y = rows.repartition(8).withColumn("y", order.keyed_permutation(F.col("x"), F.col("n"), F.lit(3)))
    got = y.groupBy("n").agg(F.countDistinct("y").alias("d"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                             F.sum((F.col("x") == F.col("y")).cast("int")).alias("fixed")).collect()
    assert len(got) == len(set(sizes))
    for g in got:
        assert (g.d, g.lo, g.hi) == (g.n, 0, g.n - 1), g
    assert sum(g.fixed for g in got if g.n > 1000) < 100          # about one fixed point a permutation


def test_epoch_batches_need_no_exchange_per_epoch(spark):
    d = spark.range(1000).withColumnRenamed("id", "doc_id")
    one, many = (order.epoch_batches(d, "doc_id", e, 16) for e in (1, 5))
    count = [x._jdf.queryExecution().executedPlan().toString().count("Exchange") for x in (one, many)]
    assert count[0] == count[1]
    rows = many.collect()
    orders = {e: tuple(x.doc_id for x in sorted((x for x in rows if x.epoch == e), key=lambda x: x.pos)) for e in range(5)}
    assert len(set(orders.values())) == 5 and all(sorted(o) == list(range(1000)) for o in orders.values())


def test_buckets_reach_the_shuffle_partitions():
    assert order.hex_digits_for(10, partitions=8) == 1 and order.hex_digits_for(10, partitions=2000) == 3
    assert order.hex_digits_for(60_000_000, partitions=16) == 3


def test_positions_read_the_input_once(spark):
    """With ``once`` both readers of X1 use the kept, range-partitioned rows."""
    plan = order.shuffle_positions(docs(spark).select("doc_id"), "doc_id", 42, once=True)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("InMemoryRelation") >= 1 and "Relation [" not in text.split("InMemoryRelation")[0]
    assert {r.doc_id: r.pos for r in plan.collect()} == naive_positions(docs(spark).select("doc_id"))


@pytest.mark.parametrize("n", [0, 1, 7, 499, 2000, 2001, 5000])
def test_prefix_numbers_only_rows_near_it(spark, n):
    ids = [i * i for i in range(2000)]
    d = spark.createDataFrame([(i, 1) for i in reversed(ids)], "doc_id long, x int").repartition(4)
    got = order.prefix_n(d, "doc_id", n).collect()
    assert sorted((r.doc_id, r.pos) for r in got) == [(v, i) for i, v in enumerate(ids[:n])]
    assert all(r.n_total == 2000 for r in got)


def test_tail_train_equals_tail_split_and_moves_no_text(spark):
    for ids, ratio in ((list(range(300)) + [None], 0.1), ([i // 3 for i in range(300)] + [None, None], 0.07), ([1, 2], 0.0), ([], 0.5)):
        df = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
        train = order.tail_train(df, "doc_id", ratio, 42)
        want = order.tail_split(df, "doc_id", ratio, 42).where("split = 'train'").select("doc_id")
        assert sorted(map(str, train.select("doc_id").collect())) == sorted(map(str, want.collect()))
    df = spark.createDataFrame([(i, "t") for i in range(100)], "doc_id long, text string")
    assert "Exchange" not in order.tail_train(df, "doc_id", 0.1, 42)._jdf.queryExecution().executedPlan().toString()


def test_whole_rows_in_input_order_lie_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(order, "TARGET_WHOLE_ROWS", 50)
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    out = order.input_positions(df, "doc_id")
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) <= 150
    assert [(r["doc_id"], r["pos"]) for r in out.orderBy("doc_id").collect()] == [(i, i) for i in range(2000)]
