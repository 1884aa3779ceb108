"""The ``word`` tokenizer: whitespace words, ids by corpus frequency.

It is the SQL-provable stand-in for BPE: every step is a built-in Spark
expression, and DuckDB can state the same result, so packing, SFT rows and
preference rows can be checked end to end without BPE.

* words: maximal runs of non-whitespace (Python ``str.split()`` semantics)
* vocabulary: specials first, then words by (count desc, word asc), cut at
  ``vocab_size`` and ``min_frequency``
* encode: words outside the vocabulary become ``<|unk|>``; special strings
  occurring as words become their special ids (the reference's behaviour)
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions.text import BOS_ID, CHAT_SPECIALS, EOS_ID, UNK_ID, WS_CLASS
from corpusforge.session import cut_lineage

WORD_PATTERN = rf"[^{WS_CLASS}]+"
# Whitespace outside ASCII, derived by rule: mapped to a space first so the
# much faster ASCII ``\S+`` gives the same words as ``WORD_PATTERN``.
_RARE_WS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \t\n\x0b\x0c\r")
#: vocabularies up to this many entries are broadcast to the encoder
MAX_BROADCAST_VOCAB = 1_000_000
#: and up to this many are a constant of the plan, where rows must stay partitioned
MAX_CONSTANT_VOCAB = 65_536


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(col: Column | str) -> Column:
    """Whitespace pre-tokenisation: ``array<string>`` of words, in order
    (maximal runs of non-whitespace, ``WORD_PATTERN``)."""
    text = F.translate(_c(col), _RARE_WS, " " * len(_RARE_WS))
    return F.regexp_extract_all(text, F.lit(r"\S+"), 0)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """T2 (word form): ``word, freq`` over the whole table.

    A hot word is no problem: the count aggregates map-side first.
    """
    # the outer form: before a plain explode Spark adds a filter that cuts every text once more
    return (df.select(F.explode_outer(words(text_col)).alias("word")).where(F.col("word").isNotNull())
            .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def specials_table(spark, specials: Sequence[str] = CHAT_SPECIALS) -> DataFrame:
    rows = [(i, s, "special") for i, s in enumerate(specials)]
    schema = "token_id int, token string, kind string"
    return spark.createDataFrame(rows, schema)


def word_vocab(counts: DataFrame, vocab_size: int, min_frequency: int = 1,
               specials: Sequence[str] = CHAT_SPECIALS) -> DataFrame:
    """Vocabulary ``token_id, token, kind`` of at most ``vocab_size`` entries.

    The cut is an exact top-K: a histogram of counts gives the K-th count,
    only words at or above it are ordered (``TakeOrderedAndProject``), and
    numbering the K survivors is a window over at most K rows.  Nothing near
    the whole word table reaches one task.
    """
    k = max(vocab_size - len(specials), 0)
    counts = cut_lineage(counts)  # the word table: read by the histogram and the cut
    eligible = counts.where((F.col("freq") >= min_frequency) & ~F.col("word").isin(list(specials)))
    # exact count cut-off from a histogram of counts (one row per distinct
    # count): the K-th word's count.  Only words at or above it reach the
    # final ordering, so tasks send ~K rows, not K rows each.
    hist = eligible.groupBy("freq").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy(F.col("freq").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = hist.withColumn("_cum", F.sum("_n").over(running)).where(F.col("_cum") >= k).agg(
        F.max("freq")).scalar()
    top = (eligible.where(F.col("freq") >= F.coalesce(cut, F.lit(0)))
           .orderBy(F.col("freq").desc(), F.col("word").asc()).limit(k))
    ranked = top.select(
        (F.row_number().over(Window.orderBy(F.col("freq").desc(), F.col("word").asc()))
         + F.lit(len(specials) - 1)).cast("int").alias("token_id"),
        F.col("word").alias("token"), F.lit("word").alias("kind"))
    return specials_table(counts.sparkSession, specials).unionByName(ranked)


def _vocab_ids(vocab: DataFrame):
    """A Column function ``words -> array<int>`` by a broadcast vocabulary; None
    if a token is there twice or ids are no ints (a join states that)."""
    if vocab.schema["token_id"].dataType != T.IntegerType():
        return None
    rows = vocab.where(F.col("token").isNotNull()).select("token", "token_id").collect()
    if len({r["token"] for r in rows}) < len(rows):
        return None
    bc = vocab.sparkSession.sparkContext.broadcast((
        [r["token"] for r in rows], [UNK_ID if r["token_id"] is None else r["token_id"] for r in rows] + [UNK_ID]))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _ids(words):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        tokens, ids = bc.value
        flat = pc.list_flatten(words)
        at = pc.index_in(flat, value_set=pa.array(tokens, flat.type)).fill_null(len(tokens))
        sizes = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.array(ids, np.int32)[at.to_numpy(zero_copy_only=False)]))

    return _ids


def _vocab_cells(vocab: DataFrame):
    """The same by built-in expressions alone, which leave rows partitioned as they
    are: the vocabulary, dealt by a checksum of the token into cells of about one
    entry, is an array in the plan (bounded by the vocabulary)."""
    if vocab.schema["token_id"].dataType != T.IntegerType():
        return None
    rows = vocab.where(F.col("token").isNotNull()).select("token", "token_id").collect()
    if len({r["token"] for r in rows}) < len(rows):
        return None
    size = max(1, len(rows))
    cells: list[list[tuple]] = [[] for _ in range(size)]
    for token, i in rows:
        cells[zlib.crc32(token.encode("utf-8")) % size].append((token, UNK_ID if i is None else i))
    # a constant of the plan (a subquery cannot stand in a function of an array)
    table = F.from_json(F.lit(json.dumps([[{"t": t, "i": i} for t, i in c] for c in cells])), "array<array<struct<t: string, i: int>>>")

    def find(w: Column) -> Column:
        cell = F.get(table, (F.crc32(w.cast("binary")) % F.lit(size)).cast("int"))
        return F.coalesce(F.get(F.filter(cell, lambda e: e["t"] == w), F.lit(0))["i"], F.lit(UNK_ID))

    def ids(tokens: Column) -> Column:
        # a one-argument lambda: Spark reads a second parameter as the index
        return F.coalesce(F.transform(tokens, lambda w: find(w)), F.array().cast("array<int>"))

    return ids


def encode_words(df: DataFrame, text_col: str, vocab: DataFrame, keys: Sequence[str],
                 out_col: str = "ids", vocab_size_bound: int | None = None,
                 carry: Sequence[str] = (), keep_partitioning: bool = False) -> DataFrame:
    """Encode ``text_col`` into ``array<int>`` ids with a word vocabulary.

    Words of a vocabulary of bounded size are looked up where the row lies, by an
    Arrow function or, if the output must stay partitioned as the input is, by
    expressions; rows of equal ``keys`` become one, their ids in position order.
    With a larger vocabulary words are exploded with their positions, looked up by an equi-join and
    re-assembled per row in position order.  ``keys`` identify a row (put the
    range-partitioning column first to keep the re-assembly shuffle-free);
    ``carry`` are further columns kept as they are.
    """
    small = vocab_size_bound is not None and vocab_size_bound <= MAX_BROADCAST_VOCAB
    encode = None
    if keep_partitioning and small and vocab_size_bound <= MAX_CONSTANT_VOCAB:
        encode = _vocab_cells(vocab)
    elif small and not keep_partitioning:
        encode = _vocab_ids(vocab)
    if encode is not None:
        coded = df.select(*keys, *carry, encode(words(text_col)).alias("_ids"))
        grouped = coded.groupBy(*keys).agg(F.collect_list("_ids").alias("_all"), *[F.first(c).alias(c) for c in carry])

        def placed(ids):
            # two parameters: Spark passes the index as the second
            return F.transform(ids, lambda x, i: F.struct(i.alias("_p"), x.alias("_id")))
        mixed = F.transform(F.array_sort(F.flatten(F.transform("_all", placed))), lambda s: s["_id"])
        return grouped.select(*keys, *carry, F.when(F.size("_all") == 1, F.col("_all")[0]).otherwise(mixed).alias(out_col))
    lookup = vocab.select(F.col("token").alias("_w"), F.col("token_id").alias("_id"))
    if small:
        lookup = F.broadcast(lookup)
    exploded = df.select(*keys, *carry, F.posexplode_outer(words(text_col)).alias("_p", "_w"))
    joined = exploded.join(lookup, on="_w", how="left")
    tok = F.when(F.col("_w").isNotNull(),
                 F.struct(F.col("_p"), F.coalesce(F.col("_id"), F.lit(UNK_ID)).alias("_id")))
    grouped = joined.groupBy(*keys).agg(
        F.array_sort(F.collect_list(tok)).alias("_toks"), *[F.first(c).alias(c) for c in carry])
    return grouped.select(*keys, *carry, F.transform("_toks", lambda s: s["_id"]).alias(out_col))


def encode_columns(df: DataFrame, cols: Sequence[str], vocab: DataFrame, keys: Sequence[str],
                   vocab_size_bound: int | None = None, suffix: str = "_ids") -> DataFrame:
    """Encode several text columns in one explode/join/group pass.

    Returns ``keys`` + one ``<col><suffix>`` array per column (text is not
    carried through the explode).  ``keys`` must be unique per row; rows whose
    columns hold no word at all come back with empty arrays.
    """
    lookup = vocab.select(F.col("token").alias("_w"), F.col("token_id").alias("_id"))
    if vocab_size_bound is not None and vocab_size_bound <= MAX_BROADCAST_VOCAB:
        lookup = F.broadcast(lookup)
    tagged = F.array(*[F.struct(F.lit(i).alias("c"), words(c).alias("ws")) for i, c in enumerate(cols)])
    ex = (df.select(*keys, F.explode(tagged).alias("_t"))
          .select(*keys, F.col("_t.c").alias("_c"), F.posexplode_outer("_t.ws").alias("_p", "_w")))
    joined = ex.join(lookup, on="_w", how="left")
    tok = F.when(F.col("_w").isNotNull(),
                 F.struct("_c", "_p", F.coalesce(F.col("_id"), F.lit(UNK_ID)).alias("_id")))
    grouped = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(tok)).alias("_toks"))

    def of_column(i: int):
        # a one-argument lambda: Spark reads a second parameter as the index
        return lambda s: s["_c"] == F.lit(i)

    return grouped.select(*keys, *[
        F.transform(F.filter("_toks", of_column(i)), lambda s: s["_id"]).alias(c + suffix)
        for i, c in enumerate(cols)])


def frame(ids: Column | str, bos: int = BOS_ID, eos: int = EOS_ID, double: bool = False) -> Column:
    """``[bos] + ids + [eos]``; ``double=True`` reproduces the reference's
    pre-training path, which frames twice (``bos bos ... eos eos``)."""
    n = 2 if double else 1
    head = F.array(*[F.lit(bos) for _ in range(n)])
    tail = F.array(*[F.lit(eos) for _ in range(n)])
    return F.concat(head, _c(ids), tail)

