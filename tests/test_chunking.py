import random

import pytest

from corpusforge.operators import chunking


def brute(rows, bound):
    out, prev, k, c = {}, None, 0, 0
    for f, ln, size in sorted(rows):
        if f != prev:
            k, c, prev = 0, 0, f
        out[(f, ln)] = k
        c += size
        if c >= bound:
            k, c = k + 1, 0
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
@pytest.mark.parametrize("parts", [1, 4, 13])
def test_greedy_chunks_equal_sequential_scan(spark, seed, parts):
    rnd = random.Random(seed)
    rows = []
    for f in range(5):
        n = 400 if f == 2 else rnd.randint(0, 30)  # file 2 is hot and spans partitions
        rows += [(f"f{f}", i, rnd.choice([0, 0, 1, 3, 7, 12, 25])) for i in range(n)]
    df = spark.createDataFrame(rows, "file string, ln int, size int")
    got = {(r.file, r.ln): r.chunk_id for r in
           chunking.greedy_chunks(df, "file", "ln", "size", 20, num_partitions=parts).collect()}
    assert got == brute(rows, 20)


def test_chunk_texts(spark):
    df = spark.createDataFrame([("a", 0, "xx"), ("a", 1, "yyy"), ("a", 2, "z")], "file string, ln int, line string")
    from pyspark.sql import functions as F

    lab = chunking.greedy_chunks(df.withColumn("size", F.length("line")), "file", "ln", "size", 4)
    t = {r.chunk_id: r.text for r in chunking.chunk_texts(lab, "file", "ln", "line").collect()}
    assert t == {0: "xx\nyyy", 1: "z"}
