import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions.responders import FlakyEchoResponder as FlakyEcho
from corpusforge.functions.responders import StubPairResponder, StubStyleResponder
from corpusforge.operators import annotate
from corpusforge.streaming.annotate_stream import annotate_stream


def test_retry_and_error_rows(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "index long, prompt string").coalesce(1)
    r = FlakyEcho({"p1": 1, "p2": 2, "p3": -1})
    got = {x["index"]: x for x in annotate.annotate(df, "prompt", r, ["index"], max_retries=3, batch_size=4).collect()}
    assert got[0].status == "ok" and got[0].reply == "P0"
    assert got[1].status == "ok" and got[2].status == "ok"
    assert got[3].status == "error" and got[3].attempts == 3 and "fail p3" in got[3].error
    assert got[5].reply == "P5"


def test_resume_yields_each_index_once(spark, tmp_dir):
    out, err = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "err")
    todo = spark.createDataFrame([(i, f"prompt number {i}") for i in range(40)], "index long, prompt string")
    first = annotate.run_resumable(todo.where("index < 25"), "prompt", StubPairResponder(), ["index"], out, err)
    assert sum(first.values()) == 25
    # rerun over everything: done keys are skipped, failures are retried
    annotate.run_resumable(todo, "prompt", StubPairResponder(), ["index"], out, err)
    done = spark.read.json(out).groupBy("index").count()
    assert done.where("count > 1").count() == 0
    assert done.count() + 0 <= 40


def test_compare_models_and_trim(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma")], "index long, text string")
    got = annotate.compare_models(df, "text", {"m1": StubStyleResponder("m1"), "m2": StubStyleResponder("m2")},
                                  ["index"]).first()
    assert got.m1.startswith("[m1]") or got.m1.startswith("[error]")
    ids = spark.createDataFrame([([1, 2, 3, 4, 5],)], "ids array<int>")
    assert list(ids.select(annotate.trim_generated("ids", 2).alias("t")).first().t) == [3, 4, 5]


def test_stream_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    rows = [{"index": i, "prompt": f"some prompt text {i}"} for i in range(30)]
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows[:20]))
    with open(os.path.join(src, "b.json"), "w") as f:  # overlaps the first file
        f.write("\n".join(json.dumps(r) for r in rows[15:]))
    schema = T.StructType([T.StructField("index", T.LongType()), T.StructField("prompt", T.StringType())])
    out, err = os.path.join(tmp_dir, "sout"), os.path.join(tmp_dir, "serr")
    q = annotate_stream(spark, src, schema, "prompt", StubPairResponder(), ["index"], out, err,
                        checkpoint=os.path.join(tmp_dir, "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    got = spark.read.json(out)
    assert got.groupBy("index").count().where("count > 1").count() == 0
    batch = annotate.annotate(spark.createDataFrame(rows, schema), "prompt", StubPairResponder(), ["index"])
    ok = {r["index"]: r.reply for r in batch.where(F.col("status") == "ok").collect()}
    streamed = {r["index"]: r.reply for r in got.collect()}
    errs = {r["index"] for r in spark.read.schema("index long").json(err).collect()} if os.path.exists(err) else set()
    assert {k: ok[k] for k in streamed} == streamed
    assert set(ok) == set(streamed) and not (errs & set(streamed))


def test_concurrency_bound(spark):
    assert annotate.concurrency_plan(50, 8) == (8, 6)
    assert annotate.concurrency_plan(200, 1000) == (200, 1)
    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "index long, prompt string")
    got = annotate.annotate(df, "prompt", FlakyEcho({}), ["index"], max_in_flight=4).collect()
    assert sorted(r["index"] for r in got) == list(range(20)) and all(r.status == "ok" for r in got)


def test_rerun_with_all_some_none_done(spark, tmp_dir):
    out, err = os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "e")
    todo = spark.createDataFrame([(i, f"p{i}") for i in range(12)], "index long, prompt string")
    # a crashed run left part of its output behind (written, nothing else recorded)
    spark.createDataFrame([(i, f"P{i}") for i in range(5)], "index long, reply string").write.json(out)
    s1 = annotate.run_resumable(todo, "prompt", FlakyEcho({"p7": -1}), ["index"], out, err)
    assert s1 == {"ok": 6, "error": 1}  # 5 already done, 7 tried, p7 fails
    s2 = annotate.run_resumable(todo, "prompt", FlakyEcho({}), ["index"], out, err)
    assert s2 == {"ok": 1}  # only the failure is retried
    s3 = annotate.run_resumable(todo, "prompt", FlakyEcho({}), ["index"], out, err)
    assert s3 == {}  # all done: nothing to call
    done = spark.read.json(out)
    assert done.count() == 12 and done.select("index").distinct().count() == 12


def test_pieces_before_a_crash_are_kept(spark, tmp_dir):
    out, err = os.path.join(tmp_dir, "po"), os.path.join(tmp_dir, "pe")
    todo = spark.createDataFrame([(i, f"p{i}") for i in range(60)], "index long, prompt string")
    last = todo.where(F.pmod(F.xxhash64("index"), F.lit(4)) == 3).first().prompt

    def dies(prompts):
        if last in prompts:
            raise SystemExit("worker lost")       # kills the task; no retry of a row could catch it
        return [p.upper() for p in prompts]
    with pytest.raises(PySparkException):
        annotate.run_resumable(todo, "prompt", dies, ["index"], out, err, pieces=4, min_piece_rows=1)
    kept = spark.read.json(out).count()
    want = todo.where(F.pmod(F.xxhash64("index"), F.lit(4)) < 3).count()
    assert kept == want > 0
    left = annotate.run_resumable(todo, "prompt", FlakyEcho({}), ["index"], out, err, pieces=4, min_piece_rows=1)
    assert left == {"ok": 60 - kept}
    assert spark.read.json(out).select("index").distinct().count() == 60 == spark.read.json(out).count()


def test_models_are_asked_in_batches():
    calls = []

    def model(name):
        def ask(prompts):
            calls.append((name, len(prompts)))
            return [f"{name}:{p}" for p in prompts]
        return ask
    routed = annotate._RoutedResponder({"a": model("a"), "b": model("b")})
    assert routed(["a\0x", "b\0x", "a\0y"]) == ["a:x", "b:x", "a:y"]
    assert calls == [("a", 2), ("b", 1)]
