"""Registered queries: sources and sinks as round trips over the driver
tables (written into the shared checkpoint folder, read back), plus F7 and
P10."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions import text as X
from corpusforge.operators import order, sft, wordtok
from corpusforge.plans import corpus
from corpusforge.plans import sqlparts as S
from corpusforge.plans.queries import CORPUS, ids_str, register, table
from corpusforge.plans.queries_rows import _SFT_SQL, M_SFT, _sft_rows
from corpusforge.session import cut_lineage, scratch_path
from corpusforge.sources import io, tokenbin


@register("k2_s2_story_roundtrip", f"""
WITH {S.split_docs_cte().strip()}
SELECT split, count(*) AS n_stories, CAST(sum(length({S.strip_sql('text')})) AS BIGINT) AS n_chars
FROM split_docs GROUP BY split""")
def q_k2(spark, d):
    docs = table(spark, d, "documents")
    split = corpus.split_documents(docs, CORPUS).select("text", "split")
    path = scratch_path(spark, "stories")
    io.write_stories(split, path)
    back = io.read_stories(spark, path)  # split comes back as the partition column
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_stories"),
                                     F.sum(F.length("text")).cast("long").alias("n_chars"))


@register("k1_s1_jsonl_roundtrip", f"""
WITH {S.chat_pairs_cte().strip()}
SELECT count(*) AS n_pairs, CAST(sum(length(instruction) + length(response)) AS BIGINT) AS n_chars FROM pairs""")
def q_k1(spark, d):
    pairs = sft.chat_pairs(table(spark, d, "conversations")).select("instruction", "response")
    path = scratch_path(spark, "pairs-jsonl")
    io.write_jsonl(pairs, path, mode="overwrite")
    back = io.read_jsonl(spark, path, io.INSTRUCTION_SCHEMA, ["instruction", "response"])
    return back.agg(F.count(F.lit(1)).alias("n_pairs"),
                    F.sum(F.length("instruction") + F.length("response")).cast("long").alias("n_chars"))


@register("k1_jsonl_append", f"""
WITH {S.chat_pairs_cte().strip()}
SELECT instruction, response, 2 AS n FROM pairs WHERE turn % 2 = 0
UNION ALL SELECT instruction, response, 1 AS n FROM pairs WHERE turn % 2 <> 0""")
def q_k1a(spark, d):
    """K1 as the jobs use it: all pairs, then those of even turns appended."""
    pairs = sft.chat_pairs(table(spark, d, "conversations"))
    path = scratch_path(spark, "pairs-appended")
    for part in (pairs, pairs.where("turn % 2 = 0")):
        io.write_jsonl(part.select("index", "instruction", "response"), path)
    schema = "index long, instruction string, response string"
    back = io.read_jsonl(spark, path, schema, ["index", "instruction", "response"])
    return back.groupBy("index", "instruction", "response").agg(F.count(F.lit(1)).cast("int").alias("n")).drop("index")


@register("s4_prefix_slice", f"""
SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS pos,
                                 count(*) OVER () AS n FROM documents)
WHERE pos < floor(n * 0.25)""")
def q_s4(spark, d):
    """Two columns of a columnar dataset, its first quarter in id order."""
    docs = io.read_table(spark, f"{d.rstrip('/')}/documents.parquet", ["doc_id", "text"])
    n = int(docs.count() * 0.25)  # from the footers
    return order.prefix_n(docs, "doc_id", n).select("doc_id", "text")


@register("k3_s5_tokenbin_roundtrip", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
    {S.doc_tokens_cte().strip()}
SELECT split, CAST(count(*) AS BIGINT) AS n_tokens, CAST(sum(tok) AS BIGINT) AS id_sum,
       CAST(sum(tok * (t % 7)) AS BIGINT) AS weighted_sum
FROM stream_tokens GROUP BY split""")
def q_k3(spark, d):
    """Each split's stream written as uint16 shards in stream order (range
    partitions by bucket, sorted by position) and read back by byte range;
    ``weighted_sum`` checks that the order survived."""
    docs = table(spark, d, "documents")
    streamed = corpus.streamed_documents(corpus.tokenize_documents(
        corpus.split_documents(docs, CORPUS), corpus.train_word_vocab(docs, CORPUS), CORPUS))
    tokenbin.register(spark)
    out = []
    for split in ("train", "validation"):
        path = tokenbin.shared_path(spark, scratch_path(spark, f"tokens-{split}"))
        part = streamed.where(F.col("split") == split).sortWithinPartitions(order.BUCKET, "order_key", "doc_id")
        part.select("ids").write.format("tokenbin").mode("append").option("path", path).save()
        back = spark.read.format("tokenbin").option("path", path).load()
        toks = back.select(F.posexplode("ids").alias("i", "tok"), "offset").select(
            (F.col("offset") + F.col("i")).alias("t"), "tok")
        out.append(toks.agg(F.lit(split).alias("split"), F.count(F.lit(1)).alias("n_tokens"),
                            F.sum("tok").cast("long").alias("id_sum"),
                            F.sum(F.col("tok") * (F.col("t") % 7)).cast("long").alias("weighted_sum")))
    return out[0].unionByName(out[1])


@register("s5_c4_sequences_from_shards", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
    {S.doc_tokens_cte().strip()}, {S.packed_cte(96, 40).strip()}
SELECT split, seq_id, input_ids, target_ids FROM packed""")
def q_s5_c4(spark, d):
    """Strided training sequences read from the packed shards of each split."""
    docs = table(spark, d, "documents")
    sd = corpus.split_documents(docs, CORPUS, once=True)
    vocab = corpus.train_word_vocab(docs, CORPUS, split_docs=sd)
    streamed = corpus.streamed_documents(corpus.tokenize_documents(sd, vocab, CORPUS))
    tokenbin.register(spark)
    out = []
    for split in ("train", "validation"):
        path = tokenbin.shared_path(spark, scratch_path(spark, f"tokens-{split}"))
        part = streamed.where(F.col("split") == split).sortWithinPartitions(order.BUCKET, "order_key", "doc_id")
        part.select("ids").write.format("tokenbin").mode("append").option("path", path).save()
        seqs = spark.read.format("tokenseq").option("path", path).option("length", 96).option("stride", 40).load()
        out.append(seqs.select(F.lit(split).alias("split"), "seq_id", ids_str("input_ids").alias("input_ids"),
                               ids_str("target_ids").alias("target_ids")))
    return out[0].unionByName(out[1])


@register("k4_s6_manifest_roundtrip", f"""{S.split_docs_cte().join(['WITH ', ''])}, {S.word_vocab_cte(4096).strip()},
    {S.doc_tokens_cte().strip()}
SELECT CAST(sum(CASE WHEN split = 'train' THEN n_tokens ELSE 0 END) AS BIGINT) AS train_tokens,
       count(CASE WHEN split = 'validation' THEN 1 END) AS val_docs
FROM doc_len""")
def q_k4m(spark, d):
    docs = table(spark, d, "documents")
    streamed = corpus.streamed_documents(corpus.tokenize_documents(
        corpus.split_documents(docs, CORPUS), corpus.train_word_vocab(docs, CORPUS), CORPUS))
    m = corpus.manifest(docs, streamed, CORPUS, CORPUS.vocab_size).select(
        "vocab_size", "train_tokens", "val_tokens", "train_docs", "val_docs",
        F.col("val_ratio").alias("sample_fraction"), F.lit(None).cast("string").alias("tokenizer_path"))
    path = scratch_path(spark, "manifest")
    io.write_manifest(m, path)
    return io.read_manifest(spark, path).select("train_tokens", "val_docs")


@register("f7_sft_split", _SFT_SQL + f""",
    sft_order AS (SELECT index, row_number() OVER (ORDER BY {S.key_sql(42, 'index')}, index) - 1 AS pos,
                       count(*) OVER () AS n FROM padded)
SELECT p.index, CASE WHEN o.pos < o.n - floor(o.n * 0.1) THEN 'train' ELSE 'validation' END AS split,
       p.n_tokens
FROM padded p JOIN sft_order o USING (index)""")
def q_f7(spark, d):
    rows = cut_lineage(_sft_rows(spark, d))  # the split reads the rows twice
    return order.random_split(rows, "index", 0.1, seed=42).select(
        "index", "split", F.col("n_tokens").cast("long").alias("n_tokens"))


@register("f7_validation_file", _SFT_SQL + """
SELECT index, CASE WHEN (index // 4294967296) % 10 = 0 THEN 'validation' ELSE 'train' END AS split, n_tokens FROM padded""")
def q_f7_file(spark, d):
    """Training and validation pairs in JSONL files of their own, read back and
    made into rows; no split is drawn."""
    from corpusforge.plans import instruct

    pairs = sft.chat_pairs(table(spark, d, "conversations"))
    vocab = corpus.train_word_vocab(table(spark, d, "documents"), CORPUS)
    schema = T.StructType([T.StructField("index", T.LongType()), *io.INSTRUCTION_SCHEMA.fields])

    def rows(part, name):
        path = scratch_path(spark, name)
        io.write_jsonl(part.select("index", "instruction", "response"), path)
        back = io.read_jsonl(spark, path, schema, ["index", "instruction", "response"])
        enc = wordtok.encode_columns(back, ["instruction", "response"], vocab, ["index"], vocab_size_bound=CORPUS.vocab_size)
        return sft.sft_rows(enc, "instruction_ids", "response_ids", M_SFT)
    held = F.col("conv_id") % 10 == 0
    out = instruct.split_rows(rows(pairs.where(~held), "sft-train"), "index",
                              validation=rows(pairs.where(held), "sft-validation"))
    return out.select("index", "split", F.col("n_tokens").cast("long").alias("n_tokens"))


@register("p10_verdict_parse", f"""
WITH replies AS (
  SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 0 THEN ' a' || chr(10) WHEN 1 THEN 'B  '
                        WHEN 2 THEN text ELSE 'A ' || text END AS reply FROM conversations)
SELECT conv_id, turn, CASE WHEN upper({S.strip_sql('reply')}) IN ('A', 'B') THEN upper({S.strip_sql('reply')}) END AS verdict
FROM replies""")
def q_p10(spark, d):
    c = table(spark, d, "conversations")
    k = (F.col("conv_id") + F.col("turn")) % 4  # bare verdicts, whole texts, verdicts with a text behind them
    raw = (F.when(k == 0, F.lit(" a\n")).when(k == 1, F.lit("B  ")).when(k == 2, F.col("text"))
           .otherwise(F.concat(F.lit("A "), F.col("text"))))
    return c.select("conv_id", "turn", X.parse_verdict(raw).alias("verdict"))


@register("s3_line_source", f"""
SELECT count(*) AS n_lines, CAST(sum(length({S.strip_sql('line')})) AS BIGINT) AS n_chars,
       count(CASE WHEN length({S.strip_sql('line')}) = 0 THEN 1 END) AS n_empty
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def q_s3(spark, d):
    """Documents written as plain text (one record per document, ended by a
    newline) and read back as stripped lines; empty lines are kept."""
    path = scratch_path(spark, "lines")
    table(spark, d, "documents").select("text").write.text(path)
    lines = io.read_lines(spark, path)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).cast("long").alias("n_chars"),
                     F.count(F.when(F.length("text") == 0, 1)).alias("n_empty"))


_REPORT_TABLES = ["documents", "conversations", "labels", "benchmark", "pages", "events", "embeddings"]


@register("s10_input_report", " UNION ALL ".join(
    f"SELECT '{t}' AS name, true AS exists, count(*) AS n_rows FROM {t}" for t in _REPORT_TABLES)
    + " UNION ALL SELECT 'missing' AS name, false AS exists, CAST(0 AS BIGINT) AS n_rows")
def q_s10(spark, d):
    inputs = {t: f"{d.rstrip('/')}/{t}.parquet" for t in _REPORT_TABLES}
    inputs["missing"] = f"{d.rstrip('/')}/missing.parquet"
    return io.input_report(spark, inputs, fmt="parquet").select("name", "exists", "n_rows")


@register("l7_trim_generated", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
    {S.doc_tokens_cte().strip()}
SELECT doc_id, CAST(greatest(n_tokens - 8, 0) AS INTEGER) AS n_generated FROM doc_len""")
def q_l7(spark, d):
    """Each document's ids treated as prompt (first 8 ids) + generation."""
    from corpusforge.operators import annotate

    docs = table(spark, d, "documents")
    toks = corpus.tokenize_documents(corpus.split_documents(docs, CORPUS), corpus.train_word_vocab(docs, CORPUS),
                                     CORPUS)
    return toks.select("doc_id", F.size(annotate.trim_generated("ids", 8)).alias("n_generated"))


@register("s7_vocab_tables", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}
SELECT kind, count(*) AS n_tokens, CAST(sum(token_id) AS BIGINT) AS id_sum FROM vocab GROUP BY kind""")
def q_s7(spark, d):
    """Vocabulary written as a tokenizer folder and read back."""
    vocab = corpus.train_word_vocab(table(spark, d, "documents"), CORPUS)
    merges = spark.createDataFrame([], "rank int, left string, right string")  # word tokenizer: no merges
    path = scratch_path(spark, "tokenizer")
    io.write_vocab(vocab, merges, path)
    back, _ = io.read_vocab(spark, path)
    return back.groupBy("kind").agg(F.count(F.lit(1)).alias("n_tokens"),
                                    F.sum("token_id").cast("long").alias("id_sum"))


@register("s9_token_cache", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
    {S.doc_tokens_cte().strip()}
SELECT split, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM doc_len GROUP BY split""")
def q_s9(spark, d):
    """Tokenized documents through the read-through cache (S9): the key hashes
    the input files' names, sizes and modification times with the tokenizer
    id, so a changed input never hits a stale entry."""
    from corpusforge.session import ensure_checkpoint_dir

    src = f"{d.rstrip('/')}/documents.parquet"
    key = io.cache_key(spark, [src], f"word-{CORPUS.vocab_size}-{CORPUS.seed}-{CORPUS.val_ratio}")

    def build():
        docs = table(spark, d, "documents")
        toks = corpus.tokenize_documents(corpus.split_documents(docs, CORPUS),
                                         corpus.train_word_vocab(docs, CORPUS), CORPUS)
        return toks.select("doc_id", "split", "ids")

    cache_dir = ensure_checkpoint_dir(spark).rstrip("/") + "/token-cache"
    cached = io.cached_table(spark, cache_dir, key, build)
    return cached.groupBy("split").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.sum(F.size("ids")).cast("long").alias("n_tokens"))


@register("s9_file_cache", f"""
SELECT doc_id % 4 = 0 AS rebuilt, count(*) AS n_docs, CAST(sum(len({S.words_sql('text')})) AS BIGINT) AS n_tokens
FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 8 = 0 GROUP BY 1""")
def q_s9_files(spark, d):
    """Documents in four folders, cached; one folder is replaced, cached again:
    only its files are tokenized anew."""
    from corpusforge.sources import tokencache

    docs = table(spark, d, "documents").select("doc_id", "text")
    src, cache = scratch_path(spark, "cache-input"), scratch_path(spark, "token-cache")
    docs.withColumn("part", F.pmod("doc_id", F.lit(4))).write.partitionBy("part").parquet(src)

    def encode(rows):
        ids = F.transform(wordtok.words("text"), lambda w: F.pmod(F.xxhash64(w), F.lit(4096)).cast("int"))
        return rows.select("doc_id", ids.alias("ids"), "file_key")

    def run():
        return tokencache.cached_tokens(spark, src, cache, "hashed-words-4096", encode)
    first = run().agg(F.max("build")).first()[0]
    docs.where("doc_id % 8 = 0").write.mode("overwrite").parquet(f"{src}/part=0")
    return run().groupBy((F.col("build") != F.lit(first)).alias("rebuilt")).agg(
        F.count("*").alias("n_docs"), F.sum(F.size("ids")).cast("long").alias("n_tokens"))
