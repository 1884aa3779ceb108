"""Vocabulary tables and line sampling (T4, T8 input, K5).

A vocabulary is a table ``token_id int, token string, kind string``; its size
is bounded by the configured vocabulary size, so it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import non_blank, strip
from corpusforge.session import cut_lineage
from corpusforge.operators.order import TARGET_ROWS_PER_BUCKET, global_position, quantile_buckets


def append_specials(vocab: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """T4: tokens already present keep their ids; new ones take the next ids
    after the current maximum, in the given order."""
    spark = vocab.sparkSession
    vocab = cut_lineage(vocab)  # bounded by the vocabulary size; read three times below
    new = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, _o int")
    new = new.join(vocab.select("token"), on="token", how="left_anti")
    top = vocab.agg(F.max("token_id")).scalar()
    added = new.select((top + F.row_number().over(Window.orderBy("_o"))).cast("int").alias("token_id"),
                       "token", F.lit("special").alias("kind"))
    return vocab.unionByName(added)


def all_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """T8 input: every non-blank line, stripped, as ``id, ln, line``."""
    return (docs.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("ln", "raw"))
            .select(id_col, "ln", strip("raw").alias("line")).where(non_blank("line")))


def first_lines(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """D4 over lines (the limit of T8's input): the first ``n`` lines of the corpus in (document, line) order,
    stripped; blank lines count towards ``n`` but are dropped.

    Only line *counts* go through X1 (a prefix sum over documents); the text
    of the few documents that hold the first ``n`` lines is then picked by a
    semi-join against at most ``n`` ids, so the corpus is never exploded.
    """
    counts = docs.select(id_col, F.size(F.split(F.col(text_col), "\n")).alias("_nl"))
    n_docs = docs.count()
    nb = max(1, -(-n_docs // TARGET_ROWS_PER_BUCKET))
    counts = quantile_buckets(counts, id_col, nb)
    off = global_position(counts, [id_col], F.col("_qbucket"), sums={"l": F.col("_nl")}, bucket_bound=nb + 1)
    head = off.where(F.col("l_offset") < n).select(id_col, "l_offset")
    head = F.broadcast(head) if n <= 5_000_000 else head
    lines = (docs.join(head, on=id_col, how="inner")
             .select(id_col, "l_offset", F.posexplode(F.split(F.col(text_col), "\n")).alias("ln", "raw")))
    return (lines.withColumn("line_pos", F.col("l_offset") + F.col("ln"))
            .where(F.col("line_pos") < n).withColumn("line", strip("raw"))
            .where(non_blank("line")).select("line_pos", id_col, "ln", "line"))


def vocab_dump(vocab: DataFrame) -> DataFrame:
    """K5: ``id <TAB> token`` lines with backslash, newline, CR and tab
    escaped (the reference prints ``repr(token)`` without its quotes)."""
    t = F.col("token")
    for raw, esc in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        t = F.replace(t, F.lit(raw), F.lit(esc))
    return vocab.select(F.concat(F.col("token_id").cast("string"), F.lit("\t"), t).alias("line"))
