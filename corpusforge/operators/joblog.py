"""Annotation jobs with one commit per piece (K1 + K6 + K7, L3-L5).

A job folder holds everything a job has done:

* ``pieces/piece=<name>``: all rows of one piece, answered and failed alike
* ``begins/piece=<name>``: one row, written before the piece is asked: its size
* ``commits/piece=<name>``: one row, written after the piece: its counts

A piece counts only when its commit row is there, so its answers, its errors and
its progress record become visible together, and a crash at any point loses and
repeats nothing that was finished: on the next run a piece that was written whole
but not committed is committed as it is (its rows are not asked again), a piece
written in part is ignored and its rows are asked again under a new name.

The rows to do are those without a committed answer (anti-join); failures are
therefore asked again, and leave the error table when they succeed.  ``answer``
is any function from the rows to do to the same rows with ``status`` ('ok' or
'error'), ``reply`` and ``error``: a model client through ``annotate``, or an
equi-join with a table of replies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from corpusforge.session import scratch_path

Answer = Callable[[DataFrame], DataFrame]
BEGIN = "rows long, at long"
COMMIT = "n_ok long, n_error long, at long"


def hash_piece(keys: Sequence[Column | str], pieces: int) -> Column:
    """Piece of a row: the first 15 hex digits of md5 of its keys, modulo."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % pieces).cast("int")


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a log folder (``piece`` from the path); empty if it is not there."""
    try:
        return spark.read.schema(schema + ", piece string").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema + ", piece string")


def _put(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """One row as one file: there or not, never in part; twice is an error."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("errorifexists").json(path)


def progress(spark: SparkSession, job: str) -> DataFrame:
    """K7: ``piece, n_ok, n_error, at, done``: one row per committed piece, ``done``
    counting all rows finished so far (one row per piece: a small table)."""
    so_far = Window.orderBy("at", "piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log = _log(spark, f"{job}/commits", COMMIT)
    return log.withColumn("done", F.sum(F.col("n_ok") + F.col("n_error")).over(so_far)).select(
        "piece", "n_ok", "n_error", "at", "done")


def rows_of(spark: SparkSession, job: str, schema: T.StructType) -> DataFrame:
    """All rows of committed pieces with their ``piece``.  The piece is the folder,
    so only committed folders are read; no list of files reaches the driver."""
    commits = _log(spark, f"{job}/commits", COMMIT).select("piece")
    full = T.StructType([*schema.fields, T.StructField("piece", T.StringType())])
    try:
        rows = spark.read.schema(full).parquet(f"{job}/pieces")
    except AnalysisException:
        return spark.createDataFrame([], full)
    return rows.join(F.broadcast(commits), "piece", "left_semi")      # one short row per piece


def answers(spark: SparkSession, job: str, schema: T.StructType) -> DataFrame:
    """K1: the rows answered."""
    return rows_of(spark, job, schema).where("status = 'ok'")


def errors(spark: SparkSession, job: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """K6: one row per key that failed and has no answer yet."""
    rows = rows_of(spark, job, schema)
    failed = rows.where("status <> 'ok'").dropDuplicates(list(keys))
    return failed.join(rows.where("status = 'ok'").select(*keys), list(keys), "left_anti")


def _commit(spark: SparkSession, job: str, piece: str, staged: DataFrame, at: int) -> None:
    n = staged.agg(F.count(F.when(F.col("status") == "ok", 1)), F.count(F.when(F.col("status") != "ok", 1))).first()
    _put(spark, f"{job}/commits/piece={piece}", COMMIT, (n[0], n[1], at))


def run_piece(part: DataFrame, answer: Answer, job: str, piece: str, rows: int, at: int) -> None:
    """Ask one piece, write it, commit it.  Nothing is done if it is committed."""
    spark = part.sparkSession
    if not _log(spark, f"{job}/commits/piece={piece}", COMMIT).isEmpty():
        return
    path = f"{job}/pieces/piece={piece}"
    if _log(spark, f"{job}/begins/piece={piece}", BEGIN).isEmpty():
        _put(spark, f"{job}/begins/piece={piece}", BEGIN, (rows, at))
    done = answer(part)
    done.write.mode("overwrite").parquet(path)
    _commit(spark, job, piece, spark.read.schema(done.schema).parquet(path), at)


def roll_forward(spark: SparkSession, job: str, schema: T.StructType) -> int:
    """Commit the pieces that a crash left written whole but not committed."""
    begun = _log(spark, f"{job}/begins", BEGIN)
    open_ = begun.join(_log(spark, f"{job}/commits", COMMIT), "piece", "left_anti").collect()   # a crash leaves one or a few
    n = 0
    for r in sorted(open_, key=lambda r: r["at"]):
        try:
            staged = spark.read.schema(schema).parquet(f"{job}/pieces/piece={r['piece']}")
        except AnalysisException:
            continue
        if staged.count() == r["rows"]:
            _commit(spark, job, r["piece"], staged, r["at"])
            n += 1
    return n


def run_job(todo: DataFrame, answer: Answer, keys: Sequence[str], job: str, pieces: int = 32,
            min_piece_rows: int = 1000, stop_after: int | None = None) -> DataFrame:
    """Ask for all rows of ``todo`` without a committed answer, piece by piece.

    The rows left are written once, in folders by a hash of their keys, so a
    piece reads its own rows only.  Small jobs are not cut up.  ``stop_after``
    ends the run after so many pieces.  Returns ``progress``."""
    spark = todo.sparkSession
    schema = answer(todo.limit(0)).schema
    roll_forward(spark, job, schema)
    left = todo.join(answers(spark, job, schema).select(*keys), list(keys), "left_anti")
    plan = scratch_path(spark, "job-todo")
    left.withColumn("_piece", hash_piece(keys, pieces)).write.partitionBy("_piece").parquet(plan)
    left = spark.read.schema(T.StructType([*todo.schema, T.StructField("_piece", T.IntegerType())])).parquet(plan)
    sizes = {r["_piece"]: r["count"] for r in left.groupBy("_piece").count().collect()}        # <= pieces rows
    steps = max(1, min(pieces, sum(sizes.values()) // max(1, min_piece_rows)))
    at = (_log(spark, f"{job}/begins", BEGIN).agg(F.max("at")).first()[0] or 0) + 1
    run = uuid.uuid4().hex[:12]
    for i in range(steps if stop_after is None else min(steps, stop_after)):
        mine = [p for p in sizes if p % steps == i]
        if mine:
            part = left.where(F.col("_piece").isin(mine)).drop("_piece")
            run_piece(part, answer, job, f"r{run}-{i}", sum(sizes[p] for p in mine), at + i)
    return progress(spark, job)


def replies_from(table: DataFrame, keys: Sequence[str], reply_col: str, missing: str = "no reply") -> Answer:
    """An ``answer`` by equi-join: the reply of the row with the same keys."""
    known = table.select(*keys, F.col(reply_col).alias("reply"))

    def answer(rows: DataFrame) -> DataFrame:
        j = rows.join(known, list(keys), "left")
        return j.select(*rows.columns, F.when(F.col("reply").isNull(), "error").otherwise("ok").alias("status"), "reply",
                        F.when(F.col("reply").isNull(), missing).alias("error"))
    return answer
