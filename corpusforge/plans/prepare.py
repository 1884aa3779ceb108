"""Corpus preparation as one Spark job (the reference's data-prep step).

    python -m corpusforge.plans.prepare --input docs.parquet --out OUT \\
        --tokenizer bpe --vocab-size 8192 [--val-ratio 0.01] [--seed 42]

Writes under ``OUT``:

* ``tokenizer/vocab``, ``tokenizer/merges`` — Parquet tables (S7)
* ``tokens/split=train|validation`` — ``doc_id, pos, ids`` in stream order (Parquet)
* ``bin/train``, ``bin/validation`` — uint16 token shards + shard manifest (K3)
* ``manifest`` — one JSON object (K4)

The input needs ``doc_id`` and ``text`` columns.  The session comes from
``spark-submit`` (or a local one when run directly); the checkpoint folder
is the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusforge.operators import order
from corpusforge.plans import corpus
from corpusforge.session import ensure_checkpoint_dir
from corpusforge.sources import io, tokenbin


def prepare(spark: SparkSession, input_path: str, out: str, tokenizer: str = "bpe", vocab_size: int = 8192,
            val_ratio: float = 0.01, seed: int = 42, sample_cap: int | None = None, bpe_mode: str = "exact",
            double_framing: bool = False) -> dict:
    ensure_checkpoint_dir(spark)
    p = corpus.CorpusParams(seed=seed, val_ratio=val_ratio, vocab_size=vocab_size,
                            tokenizer_sample_cap=sample_cap, double_framing=double_framing)
    docs = spark.read.parquet(input_path).select("doc_id", "text")
    split = corpus.split_documents(docs, p)
    if tokenizer == "bpe":
        from corpusforge.functions.text import CHAT_SPECIALS

        model = corpus.train_bpe_model(docs, p, merges=vocab_size - len(CHAT_SPECIALS) - 256, mode=bpe_mode)
        io.write_vocab(model.vocab_df(spark), model.merges_df(spark), f"{out}/tokenizer")
        toks = corpus.tokenize_documents_bpe(split, model, p)
        n_vocab = model.vocab_size
    elif tokenizer == "word":
        vocab = corpus.train_word_vocab(docs, p)
        io.write_vocab(vocab, spark.createDataFrame([], "rank int, left string, right string"), f"{out}/tokenizer")
        toks = corpus.tokenize_documents(split, vocab, p)
        n_vocab = vocab_size
    else:
        raise ValueError(tokenizer)
    streamed = corpus.streamed_documents(toks)
    ordered = streamed.sortWithinPartitions(order.BUCKET, "order_key", "doc_id")
    ordered.select("doc_id", "pos", "ids", "split").write.mode("overwrite").partitionBy("split").parquet(
        f"{out}/tokens")
    tokenbin.register(spark)
    for name in ("train", "validation"):
        (ordered.where(F.col("split") == name).select("ids").write.format("tokenbin").mode("append")
         .option("path", tokenbin.shared_path(docs.sparkSession, f"{out}/bin/{name}")).save())
    m = corpus.manifest(docs, streamed, p, n_vocab)
    io.write_manifest(m, f"{out}/manifest")
    toks.unpersist()
    return m.first().asDict()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--tokenizer", choices=["bpe", "word"], default="bpe")
    ap.add_argument("--vocab-size", type=int, default=8192)
    ap.add_argument("--val-ratio", type=float, default=0.01)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--sample-cap", type=int, default=None)
    ap.add_argument("--bpe-mode", choices=["exact", "fast"], default="exact")
    ap.add_argument("--double-framing", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("corpusforge-prepare").config("spark.ui.enabled", "false").getOrCreate()
    print(prepare(spark, a.input, a.out, a.tokenizer, a.vocab_size, a.val_ratio, a.seed, a.sample_cap,
                  a.bpe_mode, a.double_framing))


if __name__ == "__main__":
    main()
