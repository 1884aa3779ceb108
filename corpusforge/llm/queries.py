"""The thin registered queries of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import audit, blocks, nearwords, ordinal, packing, simhash, snapshots, tiling, triecount, vectors, wordmerge
from corpusforge.llm import substring_dedup as sub
from corpusforge.llm import suffix_dedup as suf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_substring_dedup")
def op1(spark, d):
    return sub.substring_dedup(table(spark, d, "documents"), with_text=False)


@query("op4_suffix_dedup")
def op4(spark, d):
    return suf.suffix_dedup(table(spark, d, "documents"))


@query("op10_simhash_dedup")
def op10(spark, d):
    return simhash.simhash_groups(table(spark, d, "documents"))


@query("op2_toxicity")
def op2(spark, d):
    docs = table(spark, d, "documents")
    model = ordinal.train(docs, table(spark, d, "labels"))
    return ordinal.score(docs, model).select("row.doc_id", "expected_severity", "severity", "p_toxic", "toxic")


@query("op6_best_fit_packing")
def op6(spark, d):
    return packing.pack(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op7_chat_snapshots", snapshots.ORACLE)
def op7(spark, d):
    return snapshots.maximal_chats(table(spark, d, "conversations"))


@query("op8_token_counts")
def op8(spark, d):
    return triecount.token_counts(table(spark, d, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@query("op9_benchmark_tiling")
def op9(spark, d):
    out = tiling.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return out.select("row.doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
                      F.array_sort("hits.item_id").alias("item_ids"),
                      F.coalesce(F.array_max("hits.coverage"), F.lit(0.0)).alias("coverage"))


@query("op3_html_extraction")
def op3(spark, d):
    return blocks.extract(table(spark, d, "pages"))


@query("op5_embedding_dedup")
def op5(spark, d):
    return vectors.embedding_dedup(table(spark, d, "embeddings"))


@query("op12_bpe_merge_rounds")
def op12(spark, d):
    path = vocabulary("byte_bpe_50k.json")
    out = wordmerge.decode(wordmerge.encode(table(spark, d, "documents"), path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_structure_repair")
def op13(spark, d):
    return audit.repair(audit.damaged(table(spark, d, "conversations")))


@query("op11_spelling_variants")
def op11(spark, d):
    return nearwords.variants(nearwords.words(table(spark, d, "documents")))
