from pyspark.sql import functions as F

from corpusforge.functions.responders import StubPairResponder, StubStyleResponder, StubVerdictResponder
from corpusforge.operators import wordtok
from corpusforge.plans import instruct


def word_encoder(spark, texts_df):
    vocab = wordtok.word_vocab(wordtok.word_counts(texts_df, "text"), 256)
    lookup = {r.token: r.token_id for r in vocab.collect()}
    m = F.create_map(*[x for k, v in lookup.items() for x in (F.lit(k), F.lit(v))])
    return lambda c: F.transform(wordtok.words(c), lambda w: F.coalesce(F.element_at(m, w), F.lit(1)))


def test_seed_to_sft_rows(spark):
    # categories and topics come from the given table
    items = spark.range(60).selectExpr("id as doc_id", "concat('lang', id % 8) as lang", "concat('topic', id % 29) as source")
    pairs, errors = instruct.generate_pairs(items, "doc_id", StubPairResponder())
    n_ok, n_err = pairs.count(), errors.count()
    assert n_ok + n_err == 60 and n_err > 0
    assert pairs.where(F.col("instruction").startswith('"')).count() == 0
    enc = word_encoder(spark, pairs.select(F.col("response").alias("text")))
    rows = instruct.sft_dataset(pairs, enc, max_length=32).collect()
    assert len(rows) == n_ok and sum(r.split == "validation" for r in rows) == int(n_ok * 0.1)
    assert all(len(r.input_ids) == 31 for r in rows)


def test_prompts_to_preference_rows(spark):
    prompts_df = spark.createDataFrame([(i, f"prompt {i} about things number {i * 7}") for i in range(30)],
                                       "item_id long, text string")
    pairs = instruct.response_pairs(prompts_df, "item_id", "text", StubStyleResponder("g"), n=20)
    prefs_df, unparsed = instruct.judge_preferences(pairs, StubVerdictResponder())
    n_pairs, n_prefs, n_unparsed = pairs.count(), prefs_df.count(), unparsed.count()
    assert n_prefs + n_unparsed == n_pairs and n_prefs > 0
    enc = word_encoder(spark, prefs_df.select(F.col("chosen").alias("text")))
    rows = instruct.preference_dataset(prefs_df, enc, max_length=24).collect()
    assert all(len(r.chosen_input_ids) == 24 and len(r.rejected_labels) == 24 for r in rows)


def test_validation_file_keeps_all_training_rows(spark):
    from pyspark.sql import functions as F

    from corpusforge.plans import instruct

    def pairs(ids):
        return spark.createDataFrame([(i, "ask this", "say that") for i in ids], "index long, instruction string, response string")

    def encode(c):
        return F.transform(F.split(c, " "), lambda w: F.length(w) + 10)
    got = instruct.sft_dataset(pairs(range(20)), encode, 16, validation=pairs([100, 101]))
    assert {r["index"]: r.split for r in got.collect()} == {**{i: "train" for i in range(20)}, 100: "validation", 101: "validation"}
    drawn = instruct.sft_dataset(pairs(range(20)), encode, 16, val_ratio=0.1)
    assert [r["count"] for r in drawn.groupBy("split").count().orderBy("split").collect()] == [18, 2]
    assert instruct.sft_dataset(pairs(range(3)), encode, 16, validation=pairs([])).where("split = 'validation'").count() == 0
