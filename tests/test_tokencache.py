import os

import pytest
from pyspark.sql import functions as F

from corpusforge.sources import tokencache


def put(spark, path, part, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{path}/f{part}")


def encode(rows):
    return rows.select("doc_id", F.transform(F.split("text", " "), lambda w: F.length(w)).alias("ids"), "file_key")


@pytest.mark.parametrize("content,listed", [(False, 100), (True, 100), (False, 1)])
def test_only_changed_files_are_tokenized(spark, tmp_dir, content, listed):
    src, cache = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "cache")
    texts = {i: [(i * 10 + k, "a bb ccc"[: 2 + k]) for k in range(4)] for i in range(5)}
    for i, rows in texts.items():
        put(spark, src, i, rows)

    def run(tokenizer="t1"):
        got = tokencache.cached_tokens(spark, src, cache, tokenizer, encode, content=content, max_listed=listed,
                                       recursiveFileLookup="true")
        rows = got.collect()
        assert sorted((r.doc_id, list(r.ids)) for r in rows) == sorted(
            (i, [len(w) for w in t.split(" ")]) for part in texts.values() for i, t in part)
        return {r.doc_id // 10: r.build for r in rows}
    first = run()
    assert len(set(first.values())) == 1 and run() == first
    texts[3] = [(30, "new words here"), (31, "x")]
    put(spark, src, 3, texts[3])
    second = run()
    assert {k for k in first if second[k] != first[k]} == {3} and run() == second
    texts[7] = [(70, "one more")]
    put(spark, src, 7, texts[7])
    third = run()
    assert {k for k in third if third[k] not in second.values()} == {7}
    # a build that died before its keys were written is not read
    spark.read.option("recursiveFileLookup", "true").parquet(src).select("doc_id", F.lit([1]).alias("ids"), F.lit("dead").alias(
        "file_key")).write.partitionBy("file_key").parquet(f"{cache}/tokens/build=bdead")
    assert run() == third
    assert not set(run("t2").values()) & set(third.values())
    del texts[7]
    os.rename(f"{src}/f7", f"{tmp_dir}/gone")
    run()
