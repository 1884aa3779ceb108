"""Registered queries: one Spark builder and (where SQL can state it) one
DuckDB oracle per operator of the inventory.

Every builder reads whole driver tables from ``sf_dir``; arrays in results
are emitted as space-joined strings so both engines hash them alike, and
floating results are rounded identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as X
from corpusforge.operators import order, pack, sft, wordtok
from corpusforge.plans import corpus
from corpusforge.plans import sqlparts as S
from corpusforge.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ids_str(col) -> F.Column:
    return F.array_join(F.col(col) if isinstance(col, str) else col, " ")


# ----------------------------------------------------------------- P: text

@register("p1_strip", f"""
SELECT conv_id, turn, length({S.strip_sql('text')}) AS stripped_chars,
       length(text) - length({S.strip_sql('text')}) AS removed_chars
FROM conversations""")
def q_p1(spark, d):
    c = table(spark, d, "conversations")
    s = X.strip("text")
    return c.select("conv_id", "turn", F.length(s).cast("long").alias("stripped_chars"),
                    (F.length("text") - F.length(s)).cast("long").alias("removed_chars"))


@register("p2_blank_filter", f"""
SELECT doc_id, n_chars FROM documents WHERE {S.non_blank_sql('text')}""")
def q_p2(spark, d):
    return table(spark, d, "documents").where(X.non_blank("text")).select("doc_id", "n_chars")


# ----------------------------------------------------------------- X1 / D

@register("x1_global_position", f"""
SELECT doc_id, row_number() OVER (ORDER BY {S.key_sql(42, 'doc_id')}, doc_id) - 1 AS pos,
       count(*) OVER () AS n_total
FROM documents""")
def q_x1(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return order.shuffle_positions(docs, "doc_id", 42).select("doc_id", "pos", "n_total")


@register("d2_exact_fraction_sample", f"""
WITH {S.split_docs_cte().strip()}
SELECT doc_id, pos FROM split_docs WHERE pos < floor(n_total * 0.25)""")
def q_d2(spark, d):
    docs = table(spark, d, "documents").where(X.non_blank("text"))
    return order.exact_fraction_sample(docs, "doc_id", 0.25, 42).select("doc_id", "pos")


@register("d3_exact_n_sample", f"""
SELECT doc_id, pos FROM (
  SELECT doc_id, row_number() OVER (ORDER BY {S.key_sql(7, 'item_id')}, item_id) - 1 AS pos, item_id
  FROM (SELECT item_id, item_id AS doc_id FROM benchmark)) WHERE pos < 25""")
def q_d3(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.col("item_id").alias("doc_id"))
    return order.exact_n_sample(b, "item_id", 25, seed=7).select("doc_id", "pos")


@register("d4_prefix_n", """
SELECT conv_id, turn FROM (
  SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id * 4294967296 + turn) - 1 AS pos FROM conversations)
WHERE pos < 400""")
def q_d4(spark, d):
    c = table(spark, d, "conversations").withColumn("row_key", sft.turn_key())
    return order.prefix_n(c, "row_key", 400).select("conv_id", "turn")


@register("d5_tail_split", f"""
WITH {S.split_docs_cte().strip()}
SELECT doc_id, pos, split FROM split_docs""")
def q_d5(spark, d):
    docs = table(spark, d, "documents").where(X.non_blank("text")).select("doc_id")
    return order.tail_split(docs, "doc_id", 0.01, 42).select("doc_id", "pos", "split")


@register("d6_head_split", """
SELECT conv_id, turn, CASE WHEN pos < floor(n * 0.1) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id * 4294967296 + turn) - 1 AS pos,
             count(*) OVER () AS n FROM conversations)""")
def q_d6(spark, d):
    c = table(spark, d, "conversations").withColumn("row_key", sft.turn_key())
    return order.head_split(c, "row_key", 0.1).select("conv_id", "turn", "split")


@register("d7_random_split", f"""
WITH {S.split_docs_cte(seed=1234, val_ratio=0.1, table='labels').strip()}
SELECT doc_id, split FROM split_docs""".replace(f"WHERE {S.non_blank_sql('text')}", ""))
def q_d7(spark, d):
    lab = table(spark, d, "labels")
    return order.random_split(lab, "doc_id", 0.1, seed=1234).select("doc_id", "split")


@register("d8_pool", f"""
SELECT origin, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (
  SELECT 'documents' AS origin, text FROM documents
  UNION ALL SELECT 'pages', html FROM pages
  UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY origin""")
def q_d8(spark, d):
    pooled = order.pool(
        table(spark, d, "documents").select(F.lit("documents").alias("origin"), "text"),
        table(spark, d, "pages").select(F.lit("pages").alias("origin"), F.col("html").alias("text")),
        table(spark, d, "benchmark").select(F.lit("benchmark").alias("origin"), "text"))
    return pooled.groupBy("origin").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.sum(F.length("text")).cast("long").alias("n_chars"))


@register("d9_capped_sample", f"""
WITH {S.split_docs_cte().strip()}
SELECT doc_id FROM split_docs WHERE split = 'train' AND pos < 500""")
def q_d9(spark, d):
    p = corpus.CorpusParams(tokenizer_sample_cap=500)
    return corpus.tokenizer_sample(table(spark, d, "documents"), p).select("doc_id")


def _plan_sql(epochs: int, batch: int, drop_last: bool) -> str:
    keep = "WHERE batch_id < floor(n / {b})".format(b=batch) if drop_last else ""
    return f"""
SELECT epoch, doc_id, batch_id FROM (
  SELECT epoch, doc_id, n,
         CAST(floor((row_number() OVER (PARTITION BY epoch ORDER BY
               md5(concat_ws(':', CAST(epoch AS VARCHAR), CAST(doc_id AS VARCHAR))), doc_id) - 1) / {batch}) AS BIGINT)
           AS batch_id
  FROM (SELECT doc_id, count(*) OVER () AS n FROM labels),
       (SELECT CAST(range AS INTEGER) AS epoch FROM range(0, {epochs}))) {keep}"""


@register("d10_batch_plan", _plan_sql(3, 16, True))
def q_d10(spark, d):
    lab = table(spark, d, "labels").select("doc_id")
    return order.batch_plan(lab, "doc_id", epochs=3, batch_size=16, drop_last=True).select(
        "epoch", "doc_id", "batch_id")


def _feistel_sql(x: str) -> str:
    """One pass over the grid cell of position ``x`` (columns epoch, a, b)."""
    def mixed(i, value, size):
        digest = f"md5(concat_ws(':', CAST(epoch AS VARCHAR), '{i}', CAST({value} AS VARCHAR)))"
        return f"CAST('0x' || substr({digest}, 1, 15) AS BIGINT) % {size}"
    src = f"SELECT *, {x} // b AS r0, {x} % b AS c0 FROM src"
    for i in range(4):
        r, c = (f"(r{i} + {mixed(i, f'c{i}', 'a')}) % a", f"c{i}") if i % 2 == 0 else (f"r{i}", f"(c{i} + {mixed(i, f'r{i}', 'b')}) % b")
        src = f"SELECT *, {r} AS r{i + 1}, {c} AS c{i + 1} FROM ({src})"
    return f"SELECT doc_id, epoch, n, a, b, r4 * b + c4 AS x FROM ({src})"


@register("d10_epoch_batches", f"""
WITH RECURSIVE base AS (
  SELECT doc_id, row_number() OVER (ORDER BY {S.key_sql(0, 'doc_id')}, doc_id) - 1 AS p, count(*) OVER () AS n FROM labels),
grid AS (SELECT *, CAST(greatest(ceil(sqrt(n)), 1) AS BIGINT) AS a FROM base),
start AS (SELECT g.*, CAST(ceil(n / a) AS BIGINT) AS b, CAST(e.range AS INTEGER) AS epoch FROM grid g, range(0, 3) e),
walk AS (
  {_feistel_sql('p').replace('FROM src', 'FROM start')}
  UNION ALL
  {_feistel_sql('x').replace('FROM src', 'FROM walk WHERE x >= n')})
SELECT epoch, doc_id, x AS pos, x // 16 AS batch_id FROM walk WHERE x < n AND x // 16 < n // 16""")
def q_d10_epochs(spark, d):
    lab = table(spark, d, "labels").select("doc_id")
    return order.epoch_batches(lab, "doc_id", epochs=3, batch_size=16, drop_last=True).select("epoch", "doc_id", "pos", "batch_id")


@register("d11_step_counts", f"""
SELECT epoch, count(DISTINCT batch_id) AS n_batches,
       CAST(floor(count(DISTINCT batch_id) / 4) AS BIGINT) AS n_steps
FROM ({_plan_sql(3, 16, False)}) GROUP BY epoch""")
def q_d11(spark, d):
    lab = table(spark, d, "labels").select("doc_id")
    plan = order.batch_plan(lab, "doc_id", epochs=3, batch_size=16, drop_last=False)
    return order.step_counts(plan, grad_accum=4)


# ----------------------------------------------------------- word tokenizer

@register("t2_word_count", f"""
SELECT word, count(*) AS freq FROM (SELECT unnest({S.words_sql('text')}) AS word FROM documents)
GROUP BY word""")
def q_t2(spark, d):
    return wordtok.word_counts(spread(table(spark, d, "documents").select("text")), "text")


CORPUS = corpus.CorpusParams(vocab_size=4096, context_length=128)


def _streamed(spark, d, p=CORPUS):
    docs = table(spark, d, "documents")
    sd = corpus.split_documents(docs, p, once=True)
    vocab = corpus.train_word_vocab(docs, p, split_docs=sd)
    return corpus.streamed_documents(corpus.tokenize_documents(sd, vocab, p))


@register("t4_vocab", f"""
WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}
SELECT token_id, token, kind FROM vocab""")
def q_t4(spark, d):
    return corpus.train_word_vocab(table(spark, d, "documents"), CORPUS)


_CORPUS_SQL = f"WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}, {S.doc_tokens_cte().strip()}"


@register("c1_tokens_per_doc", f"""{_CORPUS_SQL}
SELECT doc_id, split, n_tokens FROM doc_len""")
def q_c1(spark, d):
    return _streamed(spark, d).select("doc_id", "split", "n_tokens")


@register("t5_encode_words", f"""{_CORPUS_SQL}
SELECT doc_id, string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY j) AS ids FROM framed GROUP BY doc_id""")
def q_t5w(spark, d):
    return _streamed(spark, d).select("doc_id", ids_str("ids").alias("ids"))


@register("c2_stream_offsets", f"""{_CORPUS_SQL}
SELECT doc_id, split, tok_offset, tok_total FROM streamed""")
def q_c2(spark, d):
    return _streamed(spark, d).select("doc_id", "split", "tok_offset", "tok_total")


@register("c4_packed_sequences", f"""{_CORPUS_SQL}, {S.packed_cte(128).strip()}
SELECT split, seq_id, input_ids, target_ids FROM packed""")
def q_c4(spark, d):
    seqs = corpus.packed(_streamed(spark, d), CORPUS)
    return seqs.select("split", "seq_id", ids_str("input_ids").alias("input_ids"),
                       ids_str("target_ids").alias("target_ids"))


@register("c4_packed_strided", f"""{_CORPUS_SQL}, {S.packed_cte(96, 40).strip()}
SELECT split, seq_id, input_ids, target_ids FROM packed""")
def q_c4s(spark, d):
    seqs = pack.packed_sequences(_streamed(spark, d), 96, 40, "ids", ("split",))
    return seqs.select("split", "seq_id", ids_str("input_ids").alias("input_ids"),
                       ids_str("target_ids").alias("target_ids"))


@register("c6_stream_summary", f"""{_CORPUS_SQL}
SELECT split, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       CAST(greatest(floor((sum(n_tokens) - 129) / 128) + 1, 0) AS BIGINT) AS n_sequences,
       CAST(ceil(greatest(floor((sum(n_tokens) - 129) / 128) + 1, 0) / 8) AS BIGINT) AS n_batches,
       CAST(floor(greatest(floor((sum(n_tokens) - 129) / 128) + 1, 0) / 8) AS BIGINT) AS n_full_batches
FROM doc_len GROUP BY split""")
def q_c6(spark, d):
    return pack.stream_summary(_streamed(spark, d), 128, None, 8)


@register("k4_manifest", f"""{_CORPUS_SQL}
SELECT 4096 AS vocab_size,
       CAST(sum(CASE WHEN split = 'train' THEN n_tokens ELSE 0 END) AS BIGINT) AS train_tokens,
       CAST(sum(CASE WHEN split = 'validation' THEN n_tokens ELSE 0 END) AS BIGINT) AS val_tokens,
       count(CASE WHEN split = 'train' THEN 1 END) AS train_docs,
       count(CASE WHEN split = 'validation' THEN 1 END) AS val_docs,
       CAST(0.01 AS DOUBLE) AS val_ratio, (SELECT count(*) FROM documents) AS docs_in,
       count(*) AS docs_kept
FROM doc_len""")
def q_k4(spark, d):
    return corpus.manifest(table(spark, d, "documents"), _streamed(spark, d), CORPUS, CORPUS.vocab_size)
