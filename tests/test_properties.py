"""Property tests (hypothesis): operators against plain-Python statements
of the same rules on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.operators import chunking, order, pack

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(docs=st.lists(st.lists(st.integers(0, 50), max_size=30), min_size=1, max_size=8),
       length=st.integers(1, 12), stride=st.integers(1, 15))
def test_pack_equals_flat_slices(spark, docs, length, stride):
    rows = [(i, "train", d) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, split string, ids array<int>")
    streamed = pack.stream_offsets(df, ["doc_id"], reuse_buckets=False, bucket=F.floor(F.col("doc_id") / 3))
    got = [list(r.tokens) for r in pack.pack(streamed, length, stride).orderBy("seq_id").collect()]
    flat = [t for d in docs for t in d]
    n = max(0, (len(flat) - length - 1) // stride + 1)
    assert got == [flat[i * stride:i * stride + length + 1] for i in range(n)]


@SETTINGS
@given(ids=st.lists(st.integers(0, 10 ** 6), min_size=0, max_size=60, unique=True),
       ratio=st.sampled_from([0.01, 0.1, 0.5]))
def test_tail_split_sizes_and_positions(spark, ids, ratio):
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    rows = order.tail_split(df, "doc_id", ratio, seed=3).collect()
    assert sorted(r.pos for r in rows) == list(range(len(ids)))
    assert sum(r.split == "validation" for r in rows) == int(len(ids) * ratio)


@SETTINGS
@given(files=st.lists(st.lists(st.integers(0, 9), max_size=25), min_size=1, max_size=5),
       bound=st.integers(1, 30), parts=st.integers(1, 6))
def test_greedy_chunks_equal_scan(spark, files, bound, parts):
    rows = [(f"f{f}", i, s) for f, sizes in enumerate(files) for i, s in enumerate(sizes)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "file string, ln int, size int")
    got = {(r.file, r.ln): r.chunk_id for r in
           chunking.greedy_chunks(df, "file", "ln", "size", bound, num_partitions=parts).collect()}
    exp, prev, k, c = {}, None, 0, 0
    for f, ln, size in sorted(rows):
        if f != prev:
            k, c, prev = 0, 0, f
        exp[(f, ln)] = k
        c += size
        if c >= bound:
            k, c = k + 1, 0
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10 ** 6), st.integers(0, 9)),
                     min_size=0, max_size=60, unique_by=lambda r: r[1]),
       buckets=st.integers(1, 7))
def test_global_position_with_groups_and_sums(spark, rows, buckets):
    """X1 with partition columns and a running sum equals a sort per group."""
    df = spark.createDataFrame(rows, "g string, k long, v long")
    got = order.global_position(df, ["k"], F.col("k") % F.lit(10 ** 6 + 1) / F.lit((10 ** 6 + 1) / buckets),
                                partition_cols=["g"], sums={"v": F.col("v")},
                                bucket_bound=buckets + 1).collect()
    got = {(r.g, r.k): (r.pos, r.n_total, r.v_offset, r.v_total) for r in got}
    exp = {}
    for g in {r[0] for r in rows}:
        part = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
        acc, tot = 0, sum(r[2] for r in part)
        for i, (_, k, v) in enumerate(part):
            exp[(g, k)] = (i, len(part), acc, tot)
            acc += v
    assert got == exp
