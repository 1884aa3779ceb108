"""File sources and sinks.

All are Spark readers/writers with explicit schemas; the functions only fix
options and checks the reference relies on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from corpusforge.functions.text import STORY_SEPARATOR, strip

INSTRUCTION_SCHEMA = T.StructType([T.StructField("instruction", T.StringType()),
                                   T.StructField("response", T.StringType())])
PREFERENCE_SCHEMA = T.StructType([T.StructField("prompt", T.StringType()),
                                  T.StructField("chosen", T.StringType()),
                                  T.StructField("rejected", T.StringType())])
RESPONSE_PAIR_SCHEMA = T.StructType([T.StructField("index", T.LongType()),
                                     T.StructField("prompt", T.StringType()),
                                     T.StructField("response_a", T.StringType()),
                                     T.StructField("response_b", T.StringType())])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("vocab_size", T.IntegerType()), T.StructField("train_tokens", T.LongType()),
    T.StructField("val_tokens", T.LongType()), T.StructField("train_docs", T.LongType()),
    T.StructField("val_docs", T.LongType()), T.StructField("sample_fraction", T.DoubleType()),
    T.StructField("tokenizer_path", T.StringType())])


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
               required: Sequence[str] = ()) -> DataFrame:
    """JSON lines with a fixed schema.  Blank lines are skipped, a
    malformed line fails the job (FAILFAST), and a missing required key
    fails it too (``assert_true``) instead of becoming NULL."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not required:
        return df
    check = F.lit(True)
    for k in required:
        check = check & F.col(k).isNotNull()
    return df.where(F.assert_true(check, F.lit(f"missing required key among {list(required)}")).isNull())


def read_stories(spark: SparkSession, path: str | Sequence[str], sep: str = STORY_SEPARATOR) -> DataFrame:
    """Records separated by ``sep`` (multi-line stories stay whole)."""
    return spark.read.option("lineSep", sep).text(path).withColumnRenamed("value", "text")


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3: one row per line, stripped; empty lines are kept."""
    return spark.read.text(path).select(strip("value").alias("text"))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ("text",)) -> DataFrame:
    """A columnar dataset (Parquet); only the named columns are read."""
    return spark.read.parquet(path).select(*columns)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A single multi-line JSON object."""
    return spark.read.option("multiLine", True).schema(MANIFEST_SCHEMA).json(path)


def read_vocab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``vocab`` and ``merges`` tables; a clear error when absent."""
    try:
        return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")
    except AnalysisException as e:
        raise FileNotFoundError(
            f"no tokenizer at {path}: train one first (bpe.train_bpe) and save it with write_vocab") from e


def write_vocab(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """K1: JSON lines (appends by default)."""
    df.write.mode(mode).json(path)


def write_stories(df: DataFrame, path: str, sep: str = STORY_SEPARATOR, split_col: str | None = "split") -> None:
    """K2: stripped text followed by ``sep`` for every record, one folder per
    split (``split=train``, ``split=validation``; the whole pool is the
    parent folder), written in one pass."""
    out = df.select(strip("text").alias("value"), *([split_col] if split_col else []))
    w = out.write.mode("overwrite").option("lineSep", sep)
    if split_col:
        w = w.partitionBy(split_col)
    w.text(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """K4: the one-row manifest as a JSON object."""
    manifest.coalesce(1).write.mode("overwrite").json(path)


def input_report(spark: SparkSession, inputs: dict[str, str], fmt: str = "text") -> DataFrame:
    """For each named input, whether it exists and how many rows it has.

    Counting is a Spark job per existing input; missing inputs report 0."""
    rows = []
    for name, path in inputs.items():
        try:
            n = spark.read.format(fmt).load(path).count()
            rows.append((name, path, True, n))
        except AnalysisException:
            rows.append((name, path, False, 0))
    return spark.createDataFrame(rows, "name string, path string, exists boolean, n_rows bigint")


def cache_key(spark: SparkSession, paths: Sequence[str], tokenizer_id: str) -> str:
    """Key of a token cache from the input files' names, sizes and
    modification times (a changed file changes the key) and the tokenizer."""
    meta = (spark.read.format("binaryFile").load(list(paths))
            .select("path", "length", "modificationTime").orderBy("path").collect())
    h = hashlib.md5(tokenizer_id.encode())
    for r in meta:
        h.update(f"{r['path']}|{r['length']}|{r['modificationTime']}".encode())
    return h.hexdigest()


def cached_table(spark: SparkSession, cache_dir: str, key: str, build) -> DataFrame:
    """Read ``cache_dir/key`` if a complete copy exists, else build,
    write and read it back."""
    path = f"{cache_dir.rstrip('/')}/{key}"
    try:
        spark.read.text(f"{path}/_SUCCESS")
        return spark.read.parquet(path)
    except AnalysisException:
        build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

