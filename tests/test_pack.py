import pytest
from pyspark.sql import functions as F

from corpusforge.operators import pack


def brute(tokens, L, S):
    n = max(0, (len(tokens) - L - 1) // S + 1)
    return [tokens[i * S:i * S + L + 1] for i in range(n)]


def streamed_from(spark, docs):
    rows = [(i, "train", ids) for i, ids in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, split string, ids array<int>")
    df = df.withColumn("_bucket", F.lit("0"))
    return pack.stream_offsets(df, ["doc_id"], reuse_buckets=False, bucket=F.floor(F.col("doc_id") / 3))


CASES = {
    "empty": [[]],
    "exactly_L": [list(range(8))],
    "L_plus_1": [list(range(9))],
    "two_L": [list(range(5)), list(range(5, 16))],
    "two_L_plus_1": [list(range(10)), [], list(range(10, 17))],
    "long_doc": [list(range(3)), list(range(100, 150)), [], [7, 7]],
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("L,S", [(8, 8), (8, 3), (8, 11)])
def test_pack_equals_flat_array(spark, name, L, S):
    docs = CASES[name]
    flat = [t for d in docs for t in d]
    got = pack.pack(streamed_from(spark, docs), L, S).orderBy("seq_id").collect()
    assert [list(r.tokens) for r in got] == brute(flat, L, S)
    shifted = pack.packed_sequences(streamed_from(spark, docs), L, S).orderBy("seq_id").collect()
    for r, x in zip(shifted, brute(flat, L, S)):
        assert list(r.input_ids) == x[:-1] and list(r.target_ids) == x[1:]


def test_summary(spark):
    s = pack.stream_summary(streamed_from(spark, CASES["long_doc"]), 8, None, 2).first()
    assert s.n_tokens == 55 and s.n_sequences == (55 - 9) // 8 + 1 and s.n_batches == 3


@pytest.mark.parametrize("L,S,per", [(8, 8, 1), (8, 3, 2), (5, 7, 4), (16, 16, 30)])
@pytest.mark.parametrize("parts", [1, 5])
def test_only_border_tokens_leave_their_run(spark, L, S, per, parts):
    """Any partitioning, several streams and buckets: equal to the flat arrays,
    with at most 2 L tokens a bucket in the shuffle for S = L."""
    import random

    r = random.Random(L * S)
    rows = [(i, r.choice(["train", "validation"]), [r.randrange(1000) for _ in range(r.choice([0, 1, 3, 9, 40]))]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, split string, ids array<int>").repartition(parts)
    st = pack.stream_offsets(df, ["doc_id"], reuse_buckets=False, bucket=F.floor(F.col("doc_id") / per), bucket_bound=90)
    got = {}
    for x in pack.pack(st.repartition(parts, "doc_id"), L, S).collect():      # rows torn apart again
        assert (x.split, x.seq_id) not in got
        got[x.split, x.seq_id] = list(x.tokens)
    want = {}
    for s in ("train", "validation"):
        flat = [t for i, sp, ids in rows if sp == s for t in ids]
        want |= {(s, i): x for i, x in enumerate(brute(flat, L, S))}
    assert got == want
    if S == L and per == 30:
        moved = pack._across_runs(st, L, S, "ids", ("split",)).agg(F.sum(F.size("tokens"))).first()[0] or 0
        assert moved <= 2 * (L + 1) * st.select("split", "_bucket").distinct().count()


@pytest.mark.parametrize("L,S", [(8, 8), (8, 3), (5, 7)])
def test_texts_are_the_joined_sequences(spark, L, S, monkeypatch):
    monkeypatch.setattr(pack, "_MADE", 20)
    for name in ("empty", "L_plus_1", "long_doc"):
        got = pack.packed_texts(streamed_from(spark, CASES[name]), L, S).orderBy("seq_id").collect()
        want = brute([t for d in CASES[name] for t in d], L, S)
        assert [(r.split, r.seq_id) for r in got] == [("train", i) for i in range(len(want))]
        assert [r.input_ids for r in got] == [" ".join(map(str, x[:-1])) for x in want]
        assert [r.target_ids for r in got] == [" ".join(map(str, x[1:])) for x in want]
