"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``.  SQL cannot
express a fitted classifier, XXH64 or byte suffixes, so there is no oracle; the
stages are tested against brute force in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import ordinal, packing, simhash, suffix_dedup, tiling
from corpusforge.llm.common import written
from corpusforge.llm.queries import table, vocabulary

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model calls toxic go."""
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    return ordinal.score(docs, model).where(~F.col("toxic")).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (4-word shingles, at most 4 bits)."""
    return simhash.one_per_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under a 100-byte string that starts earlier go; a character stays
    if any of its bytes stays.  ``n_chars`` follows the text; a null text stays null."""
    src = docs.select("doc_id", "text", F.struct("*").alias("carry"))
    out = suffix_dedup.suffix_dedup(src, with_text=True, carry="carry")
    text = F.when(F.col("carry.text").isNotNull(), F.col("kept_text"))
    new = {"text": text, "n_chars": F.when(F.col("carry.text").isNull(), F.col("carry.n_chars")).otherwise(
        F.length(text).cast(docs.schema["n_chars"].dataType))} if "n_chars" in docs.columns else {"text": text}
    return out.select(*[new.get(c, F.col("carry").getField(c)).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a benchmark item go."""
    out = tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.where(F.size("hits") == 0).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed into sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
