"""Raw documents -> split -> vocabulary -> tokens -> packed sequences.

One lazy plan per step; the caller decides what to materialise.  The
documents are range-partitioned once by the bucket of their shuffle key
(X1); tokenisation, stream offsets and the manifest reuse that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import non_blank
from corpusforge.operators import order, pack, wordtok
from pyspark import StorageLevel


@dataclass(frozen=True)
class CorpusParams:
    seed: int = 42
    val_ratio: float = 0.01
    vocab_size: int = 4096
    min_frequency: int = 1
    tokenizer_sample_cap: int | None = None  # None: the whole train split
    double_framing: bool = False
    context_length: int = 128
    stride: int | None = None


def _digits(docs: DataFrame) -> int:
    """Bucket granularity from the unfiltered row count (Parquet metadata)."""
    return order.hex_digits_for(docs.count(), partitions=order.shuffle_partitions(docs))


def split_documents(docs: DataFrame, p: CorpusParams, id_col: str = "doc_id", once: bool = False) -> DataFrame:
    """P2 blank filter (unstripped text kept) + D1/D5 shuffle and tail split.
    ``once``: several steps read the result, so keep the shuffled documents."""
    kept = docs.where(non_blank("text"))
    return order.tail_split(kept, id_col, p.val_ratio, p.seed, digits=_digits(docs), once=once)


#: sample id sets up to this size are broadcast into a semi-join
MAX_BROADCAST_IDS = 5_000_000


def tokenizer_sample(docs: DataFrame, p: CorpusParams, id_col: str = "doc_id") -> DataFrame:
    """The whole train split, or (D9) its first ``cap`` documents if a cap is set.

    The split is computed on the id column alone (a narrow shuffle); the text
    is then picked by the order key, or by a semi-join against at most ``cap``
    ids, so the text is not shuffled.
    """
    kept = docs.where(non_blank("text"))
    if p.tokenizer_sample_cap is None:
        return order.tail_train(kept, id_col, p.val_ratio, p.seed, digits=_digits(docs))
    split = order.tail_split(kept.select(id_col), id_col, p.val_ratio, p.seed,
                             digits=_digits(docs))
    ids = order.capped_train_sample(split, p.tokenizer_sample_cap).select(id_col)
    if p.tokenizer_sample_cap <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return kept.join(ids, on=id_col, how="left_semi")


def train_word_vocab(docs: DataFrame, p: CorpusParams, id_col: str = "doc_id",
                     split_docs: DataFrame | None = None) -> DataFrame:
    """D9 sample -> T2 counts -> vocabulary (word tokenizer).  With no cap the
    sample is the train part of ``split_docs``, if the caller has it already."""
    if split_docs is not None and p.tokenizer_sample_cap is None:
        sample = split_docs.where("split = 'train'")
    else:
        sample = tokenizer_sample(docs, p, id_col)
    counts = wordtok.word_counts(sample, "text")
    return wordtok.word_vocab(counts, p.vocab_size, p.min_frequency)


def tokenize_documents(split_docs: DataFrame, vocab: DataFrame, p: CorpusParams,
                       id_col: str = "doc_id", materialize: bool = True) -> DataFrame:
    """T5 + T6 per document; keeps X1's bucket so the stream sum needs no shuffle.

    The tokenized table is read twice by the stream prefix sum (per-bucket
    totals and the windowed rows), so it is persisted (memory and disk)
    rather than tokenized twice.  A cached plan keeps its range partitioning
    by bucket, so the windowed read needs no shuffle; a reliable checkpoint
    would drop that partitioning and cost a shuffle of all tokens.  A lost
    cache block is recomputed from the (deterministic) lineage.  Callers
    ``unpersist()`` when done.
    """
    enc = wordtok.encode_words(split_docs, "text", vocab, keys=[order.BUCKET, id_col],
                               carry=["split", "pos", "order_key"], vocab_size_bound=p.vocab_size,
                               keep_partitioning=True)
    enc = enc.withColumn("ids", wordtok.frame("ids", double=p.double_framing))
    return enc.persist(StorageLevel.MEMORY_AND_DISK) if materialize else enc


def train_bpe_model(docs: DataFrame, p: CorpusParams, merges: int, id_col: str = "doc_id",
                    mode: str = "exact", min_frequency: int = 2):
    """D9 sample -> T2 pre-token counts -> T3 byte-level BPE."""
    from corpusforge.functions.text import CHAT_SPECIALS
    from corpusforge.operators import bpe

    words = bpe.pretoken_counts(tokenizer_sample(docs, p, id_col), "text")
    return bpe.train_bpe(words, vocab_size=len(CHAT_SPECIALS) + 256 + merges, min_frequency=min_frequency,
                         mode=mode)


def tokenize_documents_bpe(split_docs: DataFrame, model, p: CorpusParams, materialize: bool = True,
                           by_bucket: bool = False) -> DataFrame:
    """T5 + T6 with a BPE model.  Spark forgets X1's bucket partitioning at an
    Arrow UDF.  ``by_bucket`` deals kept tokens out by bucket and sorts them once;
    the stream sum and the packing, which both read them, then shuffle nothing."""
    from corpusforge.operators import bpe

    enc = bpe.encode_column(split_docs.sparkSession, model)
    out = split_docs.select(order.BUCKET, "doc_id", "split", "pos", "order_key",
                            bpe.frame(enc("text"), double=p.double_framing).alias("ids"))
    if by_bucket:
        out = out.repartition(order.shuffle_partitions(out), order.BUCKET)
        out = out.sortWithinPartitions("split", order.BUCKET, "order_key", "doc_id")
    return out.persist(StorageLevel.MEMORY_AND_DISK) if materialize else out


def streamed_documents(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """C1 + C2: tokens per document and offsets in the split's stream."""
    return pack.stream_offsets(tokens, ["order_key", id_col], "ids", stream_cols=("split",))


def packed(streamed: DataFrame, p: CorpusParams, texts: bool = False) -> DataFrame:
    """C4 + C5 per split; ``texts``: the ids as texts with blanks between them."""
    return (pack.packed_texts if texts else pack.packed_sequences)(streamed, p.context_length, p.stride, "ids", ("split",))


def manifest(docs_in: DataFrame, streamed: DataFrame, p: CorpusParams, vocab_size: int) -> DataFrame:
    """K4: one-row manifest.  ``train_docs``/``val_docs`` count the documents
    kept after the blank filter; ``docs_in`` counts the input (the reference
    mixes the two)."""
    s = streamed.agg(
        F.sum(F.when(F.col("split") == "train", F.col("n_tokens")).otherwise(0)).cast("long").alias("train_tokens"),
        F.sum(F.when(F.col("split") == "validation", F.col("n_tokens")).otherwise(0)).cast("long").alias("val_tokens"),
        F.count(F.when(F.col("split") == "train", 1)).alias("train_docs"),
        F.count(F.when(F.col("split") == "validation", 1)).alias("val_docs"),
    )
    n_in = docs_in.agg(F.count(F.lit(1))).scalar()  # scalar subquery, one value
    return s.select(F.lit(vocab_size).alias("vocab_size"), "train_tokens", "val_tokens", "train_docs",
                    "val_docs", F.lit(float(p.val_ratio)).alias("val_ratio"), n_in.alias("docs_in"),
                    (F.col("train_docs") + F.col("val_docs")).alias("docs_kept"))
