"""The annotation job over an arriving folder of prompts (Structured Streaming).

The reference has no stream engine; its one stream-shaped job is "annotate
what has not been annotated yet, append, resume after a crash".  Here that
is ``readStream`` of JSON prompt files, ``foreachBatch`` doing the same
anti-join / annotate / stage / append as the batch job, and a checkpoint in
the shared checkpoint folder.  ``trigger(availableNow=True)`` drains what is
there and stops, which is also how tests drive it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusforge.operators import joblog
from corpusforge.operators.annotate import Responder, run_resumable
from corpusforge.session import ensure_checkpoint_dir


def _checkpoint_of(spark: SparkSession, output: str) -> str:
    """Each output has a checkpoint of its own in the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{hashlib.md5(output.rstrip('/').encode()).hexdigest()}"


def job_stream(spark: SparkSession, in_dir: str, schema: T.StructType, keys: Sequence[str], answer: joblog.Answer,
               job: str, checkpoint: str | None = None, max_files_per_trigger: int = 1000):
    """L4 with state: the job of ``joblog`` over an arriving folder.

    Keys seen in earlier batches are dropped by the stream's own keyed state, and
    a batch is one piece named after its number: a batch replayed after a crash
    finds its commit (or writes the same piece again), so nothing is added twice
    and no batch reads the output of the others.  Failures stay in the job's
    error table; ``joblog.run_job`` over all rows asks for them again."""
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).json(in_dir)
            .dropDuplicates(list(keys)))

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        n = batch.count()
        if n:
            joblog.run_piece(batch, answer, job, f"b{number}", n, number)
        batch.unpersist()

    return (rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint or _checkpoint_of(spark, job))
            .trigger(availableNow=True).start())


def annotate_stream(spark: SparkSession, in_dir: str, schema: T.StructType, prompt_col: str,
                    responder: Responder, keys: Sequence[str], out_path: str, err_path: str,
                    checkpoint: str | None = None, carry: Sequence[str] = (), max_files_per_trigger: int = 1000,
                    **annotate_kwargs):
    """Start the streaming job; returns the ``StreamingQuery``.

    Each micro-batch is deduplicated on ``keys`` and anti-joined against the
    output, so a replayed batch (after a crash between the output append and
    the checkpoint commit) adds nothing twice.
    """
    checkpoint = checkpoint or _checkpoint_of(spark, out_path)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .json(in_dir))

    def each(batch: DataFrame, batch_id: int) -> None:
        todo = batch.dropDuplicates(list(keys))
        run_resumable(todo, prompt_col, responder, keys, out_path, err_path, carry=carry, **annotate_kwargs)

    return (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
