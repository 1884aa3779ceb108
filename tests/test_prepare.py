import json
import os

from corpusforge.plans import prepare


def test_prepare_writes_consistent_outputs(spark, tmp_dir):
    out = os.path.join(tmp_dir, "prep")
    m = prepare.prepare(spark, "/root/testdata/sf0.001/documents.parquet", out, tokenizer="bpe",
                        vocab_size=6 + 256 + 16, val_ratio=0.1)
    toks = spark.read.parquet(f"{out}/tokens")
    by_split = {r.split: r.n for r in toks.selectExpr("split", "size(ids) AS n").groupBy("split")
                .sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert by_split["train"] == m["train_tokens"] and by_split["validation"] == m["val_tokens"]
    for split, key in (("train", "train_tokens"), ("validation", "val_tokens")):
        man = json.load(open(f"{out}/bin/{split}/_manifest.json"))
        assert man["n_tokens"] == m[key]
    vocab = spark.read.parquet(f"{out}/tokenizer/vocab")
    assert vocab.count() == 6 + 256 + 16
    # the token shards hold the stream in position order
    first = (spark.read.format("tokenbin").option("path", f"{out}/bin/validation").load()
             .orderBy("offset").first())
    val_rows = toks.where("split = 'validation'").orderBy("pos").collect()
    assert list(first.ids[:len(val_rows[0].ids)]) == list(val_rows[0].ids)


def test_prepare_word_tokenizer(spark, tmp_dir):
    out = os.path.join(tmp_dir, "prep-word")
    m = prepare.prepare(spark, "/root/testdata/sf0.001/documents.parquet", out, tokenizer="word",
                        vocab_size=512, val_ratio=0.1)
    toks = spark.read.parquet(f"{out}/tokens")
    assert toks.count() == m["train_docs"] + m["val_docs"] == m["docs_kept"]
    assert spark.read.parquet(f"{out}/tokenizer/vocab").count() == 512
    assert json.load(open(f"{out}/bin/train/_manifest.json"))["n_tokens"] == m["train_tokens"]
