"""S9 per input file: only files that are new or have changed are tokenized.

A cache folder holds one table of tokenized rows per build, cut by the key of the
input file (``tokens/build=<id>/file_key=<key>``), and for each finished build
the keys it holds (``done/build=<id>``).  A build counts only when its keys are
written, so one that died leaves nothing that is read.  The key of a file is a
hash of the tokenizer, its path and either its size and modification time or, with
``content=True``, a hash of all its rows (one pass over the input, no shuffle of
texts).  Keys, files and rows stay in tables; the driver sees at most
``max_listed`` paths, to let Spark read the changed files only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

#: with more changed files than this all files are opened and the unchanged ones' rows left out
MAX_LISTED = 10_000


def file_keys(spark: SparkSession, path: str, tokenizer_id: str, fmt: str = "parquet", content: bool = False,
              **options) -> DataFrame:
    """``file, file_key``: one row per input file."""
    meta = F.col("_metadata")
    if content:
        rows = spark.read.options(**options).format(fmt).load(path)
        h = F.xxhash64(*rows.columns)
        # order within the file does not matter to a table; counts and sums tell repeats apart
        version = rows.select(meta["file_path"].alias("file"), h.alias("h")).groupBy("file").agg(
            F.concat_ws("|", F.count("*"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).alias("v"))
        empty = _listed(spark, path).join(version, "file", "left")
        version = empty.select("file", F.coalesce("v", F.lit("empty")).alias("v"))
    else:
        version = _listed(spark, path).select("file", F.concat_ws("|", "size", "time").alias("v"))
    return version.select("file", F.md5(F.concat_ws("|", F.lit(tokenizer_id), "file", "v")).alias("file_key"))


def _listed(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("time"))


def _done(spark: SparkSession, cache_dir: str) -> DataFrame:
    schema = "file_key string, build string"
    try:
        return spark.read.schema(schema).parquet(f"{cache_dir}/done")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def cached_tokens(spark: SparkSession, path: str, cache_dir: str, tokenizer_id: str, encode: Callable[[DataFrame], DataFrame],
                  fmt: str = "parquet", content: bool = False, max_listed: int = MAX_LISTED, **options) -> DataFrame:
    """``encode`` of the rows of ``path`` with ``file_key`` and ``build``, from the
    cache where a file has not changed.  ``encode`` works row by row and keeps the
    column ``file_key``."""
    cache_dir = cache_dir.rstrip("/")
    keys = file_keys(spark, path, tokenizer_id, fmt, content, **options).persist()
    missing = keys.join(_done(spark, cache_dir).select("file_key"), "file_key", "left_anti")
    few = [r["file"] for r in missing.select("file").limit(max_listed + 1).collect()]
    if few:
        build = uuid.uuid4().hex
        src = spark.read.options(**options).format(fmt).load(path).withColumn("_file", F.col("_metadata")["file_path"])
        if len(few) <= max_listed:
            src = src.where(F.col("_metadata")["file_path"].isin(few))          # other files are not opened
        rows = src.join(missing.withColumnRenamed("file", "_file"), "_file").drop("_file")
        out = encode(rows)
        out.write.partitionBy("file_key").parquet(f"{cache_dir}/tokens/build=b{build}")
        missing.select("file_key").write.parquet(f"{cache_dir}/done/build=b{build}")
    schema = T.StructType([f for f in encode(_with_key(spark, path, fmt, options)).schema if f.name != "file_key"]
                          + [T.StructField("build", T.StringType()), T.StructField("file_key", T.StringType())])
    current = _done(spark, cache_dir).join(keys.select("file_key"), "file_key", "left_semi").groupBy("file_key").agg(
        F.min("build").alias("build"))                                        # two builds at once may both hold a file
    keys.unpersist()
    try:
        tokens = spark.read.schema(schema).parquet(f"{cache_dir}/tokens")
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return tokens.join(current, ["file_key", "build"], "left_semi")


def _with_key(spark: SparkSession, path: str, fmt: str, options: dict) -> DataFrame:
    return spark.read.options(**options).format(fmt).load(path).limit(0).withColumn("file_key", F.lit(""))
