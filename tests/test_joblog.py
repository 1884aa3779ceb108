import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators import annotate, joblog
from corpusforge.streaming.annotate_stream import job_stream

KEYS = ["index"]


class Model:
    """Answers in capitals; counts what it is asked on the driver's side."""

    def __init__(self, fails=()):
        self.fails, self.asked = set(fails), []

    def __call__(self, rows):
        fails = sorted(self.fails)
        if rows.columns and not rows.isEmpty():
            self.asked.append(sorted(r["index"] for r in rows.select("index").collect()))
        bad = F.col("index").isin(fails) if fails else F.lit(False)
        return rows.select("index", "prompt", F.when(bad, "error").otherwise("ok").alias("status"),
                           F.when(~bad, F.upper("prompt")).alias("reply"), F.when(bad, "failed").alias("error"))


def rows(spark, n):
    return spark.createDataFrame([(i, f"p{i}") for i in range(n)], "index long, prompt string")


def state(spark, job, model):
    schema = model(rows(spark, 0)).schema
    ok = sorted(r["index"] for r in joblog.answers(spark, job, schema).collect())
    bad = sorted(r["index"] for r in joblog.errors(spark, job, schema, KEYS).collect())
    return ok, bad


def test_answers_errors_and_progress(spark, tmp_dir):
    job, model = os.path.join(tmp_dir, "job"), Model([3, 7])
    log = joblog.run_job(rows(spark, 20), model, KEYS, job, pieces=4, min_piece_rows=1).orderBy("at").collect()
    assert state(spark, job, model) == ([i for i in range(20) if i not in (3, 7)], [3, 7])
    assert len(log) == 4 and log[-1].done == 20 and sum(r.n_error for r in log) == 2
    model.fails, model.asked = {7}, []
    joblog.run_job(rows(spark, 22), model, KEYS, job, pieces=4, min_piece_rows=1)
    assert sorted(i for a in model.asked for i in a) == [3, 7, 20, 21]       # only failures and new rows
    assert state(spark, job, model) == ([i for i in range(22) if i != 7], [7])
    model.asked = []
    joblog.run_job(rows(spark, 0), model, KEYS, job)
    assert model.asked == []


def test_crash_between_write_and_commit_repeats_nothing(spark, tmp_dir, monkeypatch):
    job, model = os.path.join(tmp_dir, "job"), Model([5])
    real, calls = joblog._commit, []

    def dies(*a):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt("driver lost")
        real(*a)
    monkeypatch.setattr(joblog, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        joblog.run_job(rows(spark, 40), model, KEYS, job, pieces=5, min_piece_rows=1)
    ok, bad = state(spark, job, model)
    two = sorted(i for a in model.asked[:2] for i in a)
    assert sorted(ok + bad) == two and len(model.asked) == 3                  # the third is written, not visible
    before, model.asked = set(two) | set(model.asked[2]), []
    joblog.run_job(rows(spark, 40), model, KEYS, job, pieces=5, min_piece_rows=1)
    again = [i for a in model.asked for i in a]
    assert sorted(again) == sorted(set(range(40)) - before | ({5} & before))  # and never asked again
    assert state(spark, job, model) == ([i for i in range(40) if i != 5], [5])


def test_piece_written_in_part_is_asked_again(spark, tmp_dir):
    job, model = os.path.join(tmp_dir, "job"), Model()
    joblog._put(spark, f"{job}/begins/piece=rx-0", joblog.BEGIN, (5, 1))
    model(rows(spark, 3)).write.parquet(f"{job}/pieces/piece=rx-0")            # 3 of 5 rows
    joblog._put(spark, f"{job}/begins/piece=rx-1", joblog.BEGIN, (5, 2))       # nothing written
    model.asked = []
    joblog.run_job(rows(spark, 10), model, KEYS, job, pieces=2, min_piece_rows=100)
    assert [i for a in model.asked for i in a] == list(range(10))
    assert state(spark, job, model) == (list(range(10)), [])


def test_with_a_responder_and_by_join(spark, tmp_dir):
    todo = rows(spark, 6)

    def ask(part):
        return annotate.annotate(part, "prompt", lambda p: [x[::-1] for x in p], KEYS)
    job = os.path.join(tmp_dir, "model")
    assert joblog.run_job(todo, ask, KEYS, job).first().n_ok == 6
    table = spark.createDataFrame([(1, "one"), (4, "four")], "index long, text string")
    job, answer = os.path.join(tmp_dir, "join"), joblog.replies_from(table, KEYS, "text")
    log = joblog.run_job(todo, answer, KEYS, job).first()
    assert (log.n_ok, log.n_error) == (2, 4)


def test_stream_equals_batch_and_replays_add_nothing(spark, tmp_dir):
    src, job, model = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "job"), Model([2])
    os.makedirs(src)

    def put(name, ids):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(json.dumps({"index": i, "prompt": f"p{i}"}) for i in ids))
    schema = T.StructType([T.StructField("index", T.LongType()), T.StructField("prompt", T.StringType())])
    put("a.json", range(12))
    put("b.json", range(8, 20))
    job_stream(spark, src, schema, KEYS, model, job, max_files_per_trigger=1).awaitTermination()
    assert state(spark, job, model) == ([i for i in range(20) if i != 2], [2])
    put("c.json", [1, 2, 30])                                               # seen keys and a new one
    model.asked = []
    job_stream(spark, src, schema, KEYS, model, job, max_files_per_trigger=1).awaitTermination()
    assert model.asked == [[30]]
    # the same batch once more, as after a crash before the stream's own commit
    last = joblog.progress(spark, job).orderBy(F.col("at").desc()).first()
    model.asked = []
    joblog.run_piece(rows(spark, 40).where("index = 30"), model, job, last.piece, 1, last.at)
    assert model.asked == [] and state(spark, job, model)[0].count(30) == 1
    joblog.run_job(rows(spark, 20), Model(), KEYS, job)                       # the batch job asks for the failure
    assert state(spark, job, model) == ([*range(20), 30], [])
