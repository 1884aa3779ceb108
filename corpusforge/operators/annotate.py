"""Resumable row-wise annotation jobs.

A *responder* is any picklable ``Callable[[list[str]], list[str]]`` (a model
client, a local generator, a test stub).  ``annotate`` ships it to the
executors and calls it on Arrow batches through ``mapInPandas``: a batch is
tried whole, a failing batch is bisected down to rows, and a failing row is
retried up to ``max_retries`` times with exponential back-off.  The result
carries ``status, attempts, reply, error`` so the error table is just the
``status = 'error'`` rows.

Resume is exact and has one source of truth: the output table itself.
Keys already present there are removed by an anti-join before the run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from corpusforge.functions.text import prefix
from corpusforge.session import scratch_path

Responder = Callable[[list[str]], list[str]]

RESULT_FIELDS = [
    T.StructField("status", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("reply", T.StringType()),
    T.StructField("error", T.StringType()),
]


def _call_rows(responder: Responder, prompts: list[str], max_retries: int,
               backoff: float) -> list[tuple[str, int, str | None, str | None]]:
    """Batch first; on failure bisect; single rows retry with back-off."""
    if not prompts:
        return []
    if len(prompts) > 1:
        try:
            replies = list(responder(prompts))
            if len(replies) == len(prompts):
                return [("ok", 1, r, None) for r in replies]
        except Exception:  # noqa: BLE001 - fall through to bisection
            pass
        mid = len(prompts) // 2
        return (_call_rows(responder, prompts[:mid], max_retries, backoff)
                + _call_rows(responder, prompts[mid:], max_retries, backoff))
    last = None
    for attempt in range(max_retries):
        try:
            return [("ok", attempt + 1, responder(prompts)[0], None)]
        except Exception as e:  # noqa: BLE001
            last = f"{type(e).__name__}: {e}"
            if attempt < max_retries - 1 and backoff > 0:
                time.sleep(backoff * (2 ** attempt))
    return [("error", max_retries, None, last)]


def concurrency_plan(max_in_flight: int, max_tasks: int) -> tuple[int, int]:
    """L2: (tasks, requests per task) with ``tasks * per_task <= max_in_flight``."""
    tasks = max(1, min(max_tasks, max_in_flight))
    return tasks, max(1, max_in_flight // tasks)


def annotate(df: DataFrame, prompt_col: str, responder: Responder, keys: Sequence[str],
             max_retries: int = 3, backoff: float = 0.0, batch_size: int = 32,
             in_flight_per_task: int = 1, carry: Sequence[str] = (),
             max_in_flight: int | None = None) -> DataFrame:
    """L1 (+L2, L6): ``keys, carry, prompt_col, status, attempts, reply, error``.

    ``in_flight_per_task`` threads call the responder concurrently inside a
    task.  With ``max_in_flight`` (the reference's 50 / 200) the rows are
    spread over ``p`` tasks and each runs ``max_in_flight // p`` requests, so
    at most ``max_in_flight`` are in flight even when all tasks run at once.
    """
    cols = list(keys) + list(carry) + [prompt_col]
    base = df.select(*cols)
    if max_in_flight is not None:
        tasks, in_flight_per_task = concurrency_plan(max_in_flight,
                                                     df.sparkSession.sparkContext.defaultParallelism)
        base = base.repartition(tasks)
    schema = T.StructType([base.schema[c] for c in cols] + RESULT_FIELDS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(max_workers=max(1, in_flight_per_task))
        try:
            for pdf in batches:
                prompts = pdf[prompt_col].fillna("").tolist()
                chunks = [prompts[i:i + batch_size] for i in range(0, len(prompts), batch_size)]
                results = []
                for part in pool.map(lambda c: _call_rows(responder, c, max_retries, backoff), chunks):
                    results.extend(part)
                out = pdf[cols].copy()
                out["status"] = [r[0] for r in results]
                out["attempts"] = pd.array([r[1] for r in results], dtype="int32")
                out["reply"] = [r[2] for r in results]
                out["error"] = [r[3] for r in results]
                yield out
        finally:
            pool.shutdown()

    return base.mapInPandas(run, schema)


def remaining(todo: DataFrame, done: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """L3/L4: rows of ``todo`` whose keys are not in ``done``."""
    if done is None:
        return todo
    return todo.join(done.select(*keys).distinct(), on=list(keys), how="left_anti")


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Read a JSONL output directory, or ``None`` when it does not exist yet."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException:
        return None


def run_resumable(todo: DataFrame, prompt_col: str, responder: Responder, keys: Sequence[str],
                  out_path: str, err_path: str, carry: Sequence[str] = (),
                  preview_chars: int = 200, pieces: int = 32, min_piece_rows: int = 1000,
                  **annotate_kwargs) -> dict:
    """L1-L5 + K1/K6 as one job in up to ``pieces`` committed pieces.

    The rows left to do (anti-join against the output) are written once, cut by
    a hash of their keys.  Each piece is annotated, staged (replies are not
    recomputed) and appended -- ok rows to ``out_path``, failures (with a
    ``preview_chars`` prefix of the prompt) to ``err_path`` -- before the next
    one starts, so a job that dies loses at most the piece it was at; rows that
    failed are not in the output and are asked again on the next run.  Returns
    the job summary (L9)."""
    spark = todo.sparkSession
    out_schema = T.StructType([todo.schema[k] for k in keys] + [todo.schema[c] for c in carry]
                              + [T.StructField("reply", T.StringType())])
    done = read_if_exists(spark, out_path, out_schema)
    left = remaining(todo, done, keys).select(*keys, *carry, prompt_col)
    plan = scratch_path(spark, "annotate-todo")
    left.withColumn("_piece", F.pmod(F.xxhash64(*keys), F.lit(pieces)).cast("int")).write.parquet(plan)
    left = spark.read.schema(T.StructType([*left.schema, T.StructField("_piece", T.IntegerType())])).parquet(plan)
    n = left.count()
    steps = max(1, min(pieces, n // max(1, min_piece_rows)))   # small jobs are not cut up
    summary: dict[str, int] = {}
    for i in range(steps if n else 0):
        part = left.where(F.col("_piece") % steps == i).drop("_piece")
        ann = annotate(part, prompt_col, responder, keys, carry=carry, **annotate_kwargs)
        stage = scratch_path(spark, "annotate-stage")
        ann.write.parquet(stage)
        res = spark.read.schema(ann.schema).parquet(stage)
        res.where(F.col("status") == "ok").select(*keys, *carry, "reply").write.mode("append").json(out_path)
        (res.where(F.col("status") != "ok")
            .select(*keys, *carry, "error", "attempts", prefix(prompt_col, preview_chars).alias("preview"))
            .write.mode("append").json(err_path))
        for r in res.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect():
            summary[r["status"]] = summary.get(r["status"], 0) + r["n"]
    return summary


def job_summary(results: DataFrame, keys: Sequence[str], n_samples: int = 3) -> tuple[DataFrame, DataFrame]:
    """Counts per status and the first ``n_samples`` ok rows by key."""
    counts = results.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.sum("attempts").cast("long").alias("n_attempts"))
    samples = results.where(F.col("status") == "ok").orderBy(*keys).limit(n_samples)
    return counts, samples


def compare_models(df: DataFrame, prompt_col: str, responders: Mapping[str, Responder],
                   keys: Sequence[str], **annotate_kwargs) -> DataFrame:
    """Every model x prompt; the cell holds the reply or the error text.

    Models are attached with ``explode`` (no join); the pivot has the fixed
    list of model names as its columns."""
    names = sorted(responders)
    d = df.select(*keys, prompt_col).withColumn("model", F.explode(F.array(*[F.lit(n) for n in names])))
    routed = _RoutedResponder(dict(responders))
    tagged = d.withColumn("_routed", F.concat(F.col("model"), F.lit("\u0000"), F.col(prompt_col)))
    ann = annotate(tagged, "_routed", routed, list(keys) + ["model"], **annotate_kwargs)
    cell = F.coalesce(F.col("reply"), F.concat(F.lit("[error] "), F.col("error")))
    return ann.groupBy(*keys).pivot("model", names).agg(F.first(cell))


class _RoutedResponder:
    """Dispatches ``model\\0prompt`` strings: one call per model and batch."""

    def __init__(self, responders: Mapping[str, Responder]):
        self.responders = dict(responders)

    def __call__(self, prompts: list[str]) -> list[str]:
        asked: dict[str, list[int]] = {}
        texts: list[str] = []
        for i, p in enumerate(prompts):
            model, _, text = p.partition("\u0000")
            asked.setdefault(model, []).append(i)
            texts.append(text)
        out: list[str] = [""] * len(prompts)
        for model, rows in asked.items():
            replies = list(self.responders[model]([texts[i] for i in rows]))
            if len(replies) != len(rows):
                raise ValueError(f"{model}: {len(replies)} replies to {len(rows)} prompts")
            for i, reply in zip(rows, replies):
                out[i] = reply
        return out


def trim_generated(ids: Column | str, input_len: Column | int) -> Column:
    """Drop the first ``input_len`` ids of a generated sequence."""
    c = F.col(ids) if isinstance(ids, str) else ids
    n = input_len if isinstance(input_len, Column) else F.lit(input_len)
    return F.slice(c, (n + 1).cast("int"), F.greatest(F.size(c) - n, F.lit(0)).cast("int"))
