"""Registered queries: metrics over scored tables, candidate ranking,
annotation jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import responders
from corpusforge.functions.text import IGNORE_INDEX, parse_object, fenced_payload, strip_wrapping_quotes
from corpusforge.operators import annotate, candidates as N, joblog, metrics as Mx, order, prompts, wordtok
from corpusforge.plans import sqlparts as S
from corpusforge.plans.queries import register, table
from corpusforge.session import cut_lineage, spread

R6 = 9  # digits kept by rounded float outputs (sums of 2-decimal inputs never sit on a half at 9)

# -------------------------------------------------------------- scored table
# embeddings stand in for a scorer's output: vector k gives 64 token scores,
# blocks of 16 are (policy|reference) x (chosen|rejected); the first
# 2*label positions of each block are prompt (label -100).

_SCORED_SQL = """
    scored AS (
      SELECT vec_id AS example_id,
             CASE WHEN k < 32 THEN 'policy' ELSE 'reference' END AS model,
             CASE WHEN floor(k / 16) % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
             k % 16 AS pos,
             CASE WHEN k % 16 < label * 2 THEN -100 ELSE CAST(k % 16 AS INTEGER) END AS label,
             -abs(CAST(x AS DOUBLE)) * 10 AS logp
      FROM (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS k FROM embeddings))"""


def scored_table(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings")
    ex = e.select("vec_id", F.col("label").alias("_lab"), F.posexplode("embedding").alias("k", "x"))
    pos = F.col("k") % 16
    return ex.select(
        F.col("vec_id").alias("example_id"),
        F.when(F.col("k") < 32, "policy").otherwise("reference").alias("model"),
        F.when(F.floor(F.col("k") / 16) % 2 == 0, "chosen").otherwise("rejected").alias("side"),
        pos.alias("pos"),
        F.when(pos < F.col("_lab") * 2, F.lit(IGNORE_INDEX)).otherwise(pos.cast("int")).alias("label"),
        (-F.abs(F.col("x").cast("double")) * 10).alias("logp"))


@register("m1_sequence_logprob", f"""WITH {_SCORED_SQL.strip()}
SELECT model, example_id, side, round(sum(CASE WHEN label <> -100 THEN logp ELSE 0.0 END), {R6}) AS seq_logp,
       count(CASE WHEN label <> -100 THEN 1 END) AS n_scored
FROM scored GROUP BY model, example_id, side""")
def q_m1(spark, d):
    s = Mx.sequence_logprob(scored_table(spark, d))
    return s.withColumn("seq_logp", F.round("seq_logp", R6))


_DPO_SQL = f"""WITH {_SCORED_SQL.strip()},
    seq AS (SELECT model, example_id, side, sum(CASE WHEN label <> -100 THEN logp ELSE 0.0 END) AS seq_logp
            FROM scored GROUP BY ALL),
    ex AS (SELECT example_id,
                  sum(CASE WHEN model = 'policy' AND side = 'chosen' THEN seq_logp END) AS pi_c,
                  sum(CASE WHEN model = 'policy' AND side = 'rejected' THEN seq_logp END) AS pi_r,
                  sum(CASE WHEN model = 'reference' AND side = 'chosen' THEN seq_logp END) AS ref_c,
                  sum(CASE WHEN model = 'reference' AND side = 'rejected' THEN seq_logp END) AS ref_r
           FROM seq GROUP BY example_id),
    zt AS (SELECT *, 0.1 * ((pi_c - pi_r) - (ref_c - ref_r)) AS z FROM ex),
    per AS (SELECT example_id, z, greatest(-z, 0.0) + ln(1 + exp(-abs(z))) AS loss,
                   CASE WHEN z > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS correct,
                   0.1 * (pi_c - ref_c) AS chosen_reward, 0.1 * (pi_r - ref_r) AS rejected_reward FROM zt)"""


def _dpo(spark, d):
    return Mx.dpo_example_metrics(Mx.sequence_logprob(scored_table(spark, d)), beta=0.1)


@register("m2_dpo_example_metrics", _DPO_SQL + f"""
SELECT example_id, round(z, {R6}) AS z, round(loss, {R6}) AS loss, correct,
       round(chosen_reward, {R6}) AS chosen_reward, round(rejected_reward, {R6}) AS rejected_reward,
       round(chosen_reward - rejected_reward, {R6}) AS margin
FROM per""")
def q_m2(spark, d):
    p = _dpo(spark, d)
    return p.select("example_id", *[F.round(c, R6).alias(c) if c != "correct" else F.col(c)
                                    for c in ("z", "loss", "correct", "chosen_reward", "rejected_reward", "margin")])


@register("m2_dpo_summary", _DPO_SQL + f"""
SELECT count(*) AS n_pairs, round(avg(loss), {R6}) AS loss, round(avg(correct), {R6}) AS accuracy,
       round(avg(chosen_reward), {R6}) AS chosen_reward, round(avg(rejected_reward), {R6}) AS rejected_reward,
       round(avg(chosen_reward - rejected_reward), {R6}) AS margin
FROM per""")
def q_m2s(spark, d):
    s = Mx.dpo_summary(_dpo(spark, d))
    return s.select("n_pairs", *[F.round(c, R6).alias(c) for c in
                                 ("loss", "accuracy", "chosen_reward", "rejected_reward", "margin")])


def _ce_tokens(spark, d):
    s = scored_table(spark, d)
    return s.select("model", (F.floor(F.col("example_id") / 8)).cast("long").alias("batch_id"), "side", "label",
                    (-F.col("logp")).alias("ce"),
                    F.when(F.col("label") != IGNORE_INDEX, 1.0).otherwise(0.0).alias("mask"))


@register("m3_masked_mean_ce", f"""WITH {_SCORED_SQL.strip()}
SELECT model, CAST(floor(example_id / 8) AS BIGINT) AS batch_id,
       round(sum(-logp * CASE WHEN label <> -100 THEN 1.0 ELSE 0.0 END)
             / (sum(CASE WHEN label <> -100 THEN 1.0 ELSE 0.0 END) + 1e-8), {R6}) AS masked_ce,
       CAST(sum(CASE WHEN label <> -100 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS n_scored
FROM scored GROUP BY ALL""")
def q_m3(spark, d):
    m = Mx.masked_mean_ce(_ce_tokens(spark, d), ["model", "batch_id"])
    return m.select("model", "batch_id", F.round("masked_ce", R6).alias("masked_ce"), "n_scored")


@register("m4_mean_ce_ignoring", f"""WITH {_SCORED_SQL.strip()}
SELECT model, side, round(avg(CASE WHEN label <> -100 THEN -logp END), {R6}) AS mean_ce,
       count(CASE WHEN label <> -100 THEN 1 END) AS n_kept
FROM scored GROUP BY model, side""")
def q_m4(spark, d):
    m = Mx.mean_ce_ignoring(_ce_tokens(spark, d), ["model", "side"])
    return m.select("model", "side", F.round("mean_ce", R6).alias("mean_ce"), "n_kept")


# ------------------------------------------------------------- metric logs
# events stand in for a training log: user_id = run, value = loss, ts = step
# order, epoch = 10-day period of ts, batches of 4 steps.

_LOG_SQL = """
    log AS (SELECT event_id, user_id AS run, value AS loss, ts,
                   CAST(floor((dayofmonth(ts) - 1) / 10) AS INTEGER) AS epoch FROM events),
    steps AS (SELECT *, row_number() OVER (PARTITION BY run, epoch ORDER BY ts, event_id) - 1 AS step,
                     sum(loss) OVER (PARTITION BY run, epoch ORDER BY ts, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_loss
              FROM log)"""


def _log(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.col("user_id").alias("run"), F.col("value").alias("loss"), "ts",
                    F.floor((F.dayofmonth("ts") - 1) / 10).cast("int").alias("epoch"))


def _steps(spark, d):
    lg = _log(spark, d).withColumn("_sec", F.unix_micros(F.col("ts").cast("timestamp")))
    # time buckets from quantiles: a run's burst of events spreads over many buckets
    n_buckets = max(2, min(4_096, -(-lg.count() // 2_000)))          # their bounds pass through the driver
    lg = order.quantile_buckets(lg, "_sec", n_buckets)
    r = Mx.running_mean(lg, ["run", "epoch"], ["ts", "event_id"], F.col("_qbucket"), "loss",
                        bucket_bound=n_buckets + 1, partition_fanout=1 << 12)
    return r.withColumn("batch_id", F.floor(F.col("step") / 4).cast("long"))


@register("m7_running_mean", f"""WITH {_LOG_SQL.strip()}
SELECT event_id, run, epoch, step, round(cum_loss / (step + 1), {R6}) AS running_mean FROM steps""")
def q_m7(spark, d):
    s = _steps(spark, d)
    return s.select("event_id", "run", "epoch", "step", F.round("running_mean", R6).alias("running_mean"))


_EPOCH_SQL = f"""WITH {_LOG_SQL.strip()},
    batches AS (SELECT run, epoch, floor(step / 4) AS batch_id, avg(loss) AS bm, count(*) AS bn, sum(loss) AS bs
                FROM steps GROUP BY ALL),
    epochs AS (SELECT run, epoch, avg(bm) AS mean_of_batch_means, sum(bs) / sum(bn) AS row_weighted_mean,
                      count(*) AS n_batches, sum(bn) AS n_rows FROM batches GROUP BY run, epoch)"""


def _epochs(spark, d):
    return Mx.epoch_metric(_steps(spark, d), ["run", "epoch"], "batch_id", "loss")


@register("m5_epoch_metric", _EPOCH_SQL + f"""
SELECT run, epoch, round(mean_of_batch_means, {R6}) AS mean_of_batch_means,
       round(row_weighted_mean, {R6}) AS row_weighted_mean, n_batches, CAST(n_rows AS BIGINT) AS n_rows
FROM epochs""")
def q_m5(spark, d):
    e = _epochs(spark, d)
    return e.select("run", "epoch", F.round("mean_of_batch_means", R6).alias("mean_of_batch_means"),
                    F.round("row_weighted_mean", R6).alias("row_weighted_mean"), "n_batches",
                    F.col("n_rows").cast("long").alias("n_rows"))


@register("m6_best_epoch", _EPOCH_SQL + f"""
SELECT e.run, min(e.epoch) AS best_epoch, round(min(m.mv), {R6}) AS best_val_loss
FROM (SELECT run, epoch, round(mean_of_batch_means, 9) AS v FROM epochs) e
JOIN (SELECT run, min(round(mean_of_batch_means, 9)) AS mv FROM epochs GROUP BY run) m
  ON e.run = m.run AND e.v = m.mv
GROUP BY e.run""")
def q_m6(spark, d):
    e = _epochs(spark, d).select("run", "epoch", F.round("mean_of_batch_means", 9).alias("val_loss"))
    b = Mx.best_epoch(e)
    return b.select("run", "best_epoch", F.round("best_val_loss", R6).alias("best_val_loss"))


@register("m6_is_best", _EPOCH_SQL + """
SELECT run, epoch, coalesce(v < min(v) OVER (PARTITION BY run ORDER BY epoch
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_best
FROM (SELECT run, epoch, round(mean_of_batch_means, 9) AS v FROM epochs)""")
def q_m6b(spark, d):
    e = _epochs(spark, d).select("run", "epoch", F.round("mean_of_batch_means", 9).alias("val_loss"))
    return Mx.mark_improvements(e).select("run", "epoch", "is_best")


@register("m8_every_nth_step", f"""WITH {_LOG_SQL.strip()}
SELECT event_id, run, epoch, step FROM steps WHERE step % 10 = 0""")
def q_m8(spark, d):
    return Mx.every_nth(_steps(spark, d), "step", 10).select("event_id", "run", "epoch", "step")


# ------------------------------------------------------------- candidates

_EMB_CANDS_SQL = """
    cands AS (SELECT vec_id AS context_id, k AS item_id, CAST(x AS DOUBLE) * 10 AS score
              FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS k FROM embeddings)),
    sm AS (SELECT *, exp(score / 0.7 - max(score / 0.7) OVER (PARTITION BY context_id)) AS e FROM cands),
    probs AS (SELECT context_id, item_id, score, e / sum(e) OVER (PARTITION BY context_id) AS prob FROM sm)"""


def emb_candidates(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias(N.CTX), F.posexplode("embedding").alias(N.ITEM, "_x")).select(
        N.CTX, F.col(N.ITEM).cast("long").alias(N.ITEM), (F.col("_x").cast("double") * 10).alias(N.SCORE))


@register("n1_softmax", f"""WITH {_EMB_CANDS_SQL.strip()}
SELECT context_id, item_id, round(prob, 9) AS prob FROM probs""")
def q_n1(spark, d):
    p = N.softmax(emb_candidates(spark, d), temperature=0.7)
    return p.select(N.CTX, N.ITEM, F.round("prob", 9).alias("prob"))


def _bigram_sql() -> str:
    w = S.words_sql("text")
    return f"""
    bigrams AS (SELECT unnest(w[1:len(w) - 1]) AS context_id, unnest(w[2:len(w)]) AS item_id
                FROM (SELECT {w} AS w FROM documents)),
    cands AS (SELECT context_id, item_id, CAST(count(*) AS DOUBLE) AS score FROM bigrams GROUP BY ALL)"""


def bigrams(spark, d):
    """Corpus bigram candidates, written once to the shared checkpoint folder
    (the ranking operators read their input several times)."""
    docs = spread(table(spark, d, "documents").select("text")).select(wordtok.words("text").alias("words"))
    return cut_lineage(N.bigram_candidates(docs, "words"))


@register("n2_top_k_with_ties", f"""WITH {_bigram_sql().strip()},
    kth AS (SELECT context_id, min(score) AS kth FROM (
              SELECT *, row_number() OVER (PARTITION BY context_id ORDER BY score DESC, item_id) AS rn FROM cands)
            WHERE rn <= 3 GROUP BY context_id),
    kept AS (SELECT c.* FROM cands c JOIN kth USING (context_id) WHERE c.score >= kth.kth),
    sm AS (SELECT *, exp(score - max(score) OVER (PARTITION BY context_id)) AS e FROM kept)
SELECT context_id, item_id, score, round(e / sum(e) OVER (PARTITION BY context_id), 9) AS prob FROM sm""")
def q_n2(spark, d):
    k = N.top_k_with_ties(bigrams(spark, d), k=3, temperature=1.0)
    return k.select(N.CTX, N.ITEM, N.SCORE, F.round("prob", 9).alias("prob"))


@register("n3_top_k_exact", f"""WITH {_bigram_sql().strip()}
SELECT context_id, item_id, score, rank_in_context FROM (
  SELECT *, row_number() OVER (PARTITION BY context_id ORDER BY score DESC, item_id) AS rank_in_context FROM cands)
WHERE rank_in_context <= 5""")
def q_n3(spark, d):
    return N.top_k_exact(bigrams(spark, d), k=5).select(N.CTX, N.ITEM, N.SCORE,
                                                         F.col("rank_in_context").cast("long").alias("rank_in_context"))


@register("n4_nucleus", f"""WITH {_EMB_CANDS_SQL.strip()},
    top AS (SELECT *, row_number() OVER (PARTITION BY context_id ORDER BY prob DESC, item_id) AS rank_in_context
            FROM probs),
    cum AS (SELECT *, sum(prob) OVER (PARTITION BY context_id ORDER BY rank_in_context
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_prob
            FROM top WHERE rank_in_context <= 20)
SELECT context_id, item_id, rank_in_context, round(prob, 9) AS prob FROM cum
WHERE cum_prob <= 0.5 OR rank_in_context = 1""")
def q_n4(spark, d):
    n = N.nucleus(emb_candidates(spark, d), k=20, top_p=0.5, temperature=0.7)
    return n.select(N.CTX, N.ITEM, F.col("rank_in_context").cast("long").alias("rank_in_context"),
                    F.round("prob", 9).alias("prob"))


@register("n5_weighted_draw", f"""WITH {_EMB_CANDS_SQL.strip()},
    g AS (SELECT context_id, item_id,
                 ln(prob) - ln(-ln((CAST(CAST('0x' || substr(md5(concat_ws(':', '3', CAST(context_id AS VARCHAR),
                     CAST(item_id AS VARCHAR))), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / {16 ** 13}.0)) AS gk
          FROM probs WHERE prob > 0)
SELECT context_id, arg_max(item_id, gk) AS drawn_item FROM g GROUP BY context_id""")
def q_n5(spark, d):
    return N.weighted_draw(N.softmax(emb_candidates(spark, d), temperature=0.7), seed=3)


@register("n6_cut_at_eos", f"""
SELECT doc_id, array_to_string(CASE WHEN list_position(ids, 3) IS NULL THEN ids
                                    ELSE ids[1:list_position(ids, 3) - 1] END, ' ') AS kept_ids
FROM (SELECT doc_id, list_transform({S.words_sql('text')}, lambda x: length(x)) AS ids FROM documents)""")
def q_n6(spark, d):
    # ids stand-in: word lengths; a three-letter word plays the end marker (id 3)
    docs = table(spark, d, "documents")
    ids = F.transform(wordtok.words("text"), lambda x: F.length(x))
    return docs.select("doc_id", F.array_join(N.cut_at_eos(ids, 3), " ").alias("kept_ids"))


@register("n7_keep_last", f"""
SELECT doc_id, array_to_string(CASE WHEN len(w) > 16 THEN w[len(w) - 15:len(w)] ELSE w END, ' ') AS tail_words
FROM (SELECT doc_id, {S.words_sql('text')} AS w FROM documents)""")
def q_n7(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.array_join(N.keep_last(wordtok.words("text"), 16), " ").alias("tail_words"))


# ---------------------------------------------------------- annotation jobs

# SQL restatements of the deterministic stub responders (functions/responders.py)
def _h_sql(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 8) AS BIGINT)"


def _style_reply_sql(style: str, text: str) -> str:
    w = S.words_sql(text)
    return f"'[{style}] ' || array_to_string(({w})[1:5 + {_h_sql(text)} % 20], ' ')"


def _style_fails_sql(style: str, text: str) -> str:
    return f"{_h_sql(S.q(style) + ' || ' + text)} % 10 = 0"


def _sft_annotation(spark, d):
    items = table(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id")
    sp = prompts.story_prompts(items, "doc_id", "text")
    return annotate.annotate(sp, "prompt", responders.StubPairResponder(), ["index"], max_retries=3,
                             batch_size=8, max_in_flight=50)


def _story_prompt_sql(text: str) -> str:
    head, tail = prompts.STORY_TEMPLATE.split("{story}")
    return f"{S.q(head)} || {text} || {S.q(tail)}"


@register("l1_annotate_pairs", f"""
WITH p AS (SELECT item_id AS index, {_story_prompt_sql('text')} AS prompt FROM benchmark),
     w AS (SELECT index, prompt, {S.words_sql('prompt')} AS ws, {_h_sql('prompt')} AS h FROM p)
SELECT index,
       CASE WHEN h % 16 = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN h % 16 = 0 THEN NULL ELSE 'Write about ' || array_to_string(ws[1:6], ' ') END AS instruction,
       CASE WHEN h % 16 = 0 THEN NULL ELSE array_to_string(list_reverse(ws[1:40]), ' ') END AS response,
       CASE WHEN h % 16 = 0 THEN 'TransientError: permanent failure for prompt ' || substr(md5(prompt), 1, 8) END
         AS error
FROM w""")
def q_l1(spark, d):
    a = _sft_annotation(spark, d)
    parsed = parse_object(fenced_payload("reply"), ["instruction", "response"])
    return a.select("index", "status", strip_wrapping_quotes(parsed["instruction"]).alias("instruction"),
                    parsed["response"].alias("response"), "error")


@register("l3_resume_anti_join", """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_l3(spark, d):
    return annotate.remaining(table(spark, d, "documents").select("doc_id"),
                              table(spark, d, "labels"), ["doc_id"])


@register("l8_compare_models", f"""
SELECT item_id AS index,
       CASE WHEN {_style_fails_sql('terse', 'text')} THEN '[error] TransientError: style call failed'
            ELSE {_style_reply_sql('terse', 'text')} END AS terse,
       CASE WHEN {_style_fails_sql('warm', 'text')} THEN '[error] TransientError: style call failed'
            ELSE {_style_reply_sql('warm', 'text')} END AS warm
FROM benchmark""")
def q_l8(spark, d):
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("index"), "text")
    return annotate.compare_models(items, "text", {"terse": responders.StubStyleResponder("terse"),
                                                   "warm": responders.StubStyleResponder("warm")}, ["index"])


@register("l9_job_summary", f"""
SELECT CASE WHEN {_h_sql(_story_prompt_sql('text'))} % 16 = 0 THEN 'error' ELSE 'ok' END AS status,
       count(*) AS n_rows
FROM benchmark GROUP BY 1""")
def q_l9(spark, d):
    counts, _ = annotate.job_summary(_sft_annotation(spark, d), ["index"])
    return counts.select("status", "n_rows")


@register("g7_contrastive_pairs", f"""
SELECT item_id AS index, text AS prompt, {_style_reply_sql('plain', 'text')} AS chosen,
       {_style_reply_sql('rich', 'text')} AS rejected
FROM benchmark
WHERE NOT ({_style_fails_sql('plain', 'text')}) AND NOT ({_style_fails_sql('rich', 'text')})""")
def q_g7(spark, d):
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("index"), "text")
    a = annotate.annotate(items, "text", responders.StubStyleResponder("plain"), ["index"])
    b = annotate.annotate(items, "text", responders.StubStyleResponder("rich"), ["index"])
    ok_a = a.where(F.col("status") == "ok").select("index", F.col("text").alias("prompt"), F.col("reply").alias("chosen"))
    ok_b = b.where(F.col("status") == "ok").select("index", F.col("reply").alias("rejected"))
    return ok_a.join(ok_b, on="index", how="inner")


@register("g6_candidate_pairing", f"""
WITH c AS (SELECT item_id AS index, 'a: ' || text AS pa, 'b: ' || text AS pb FROM benchmark)
SELECT index, {_style_reply_sql('sample', 'pa')} AS response_a, {_style_reply_sql('sample', 'pb')} AS response_b
FROM c
WHERE NOT ({_style_fails_sql('sample', 'pa')}) AND NOT ({_style_fails_sql('sample', 'pb')})""")
def q_g6(spark, d):
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("index"), "text")
    cand = items.withColumn("cand", F.explode(F.array(F.lit("a"), F.lit("b"))))
    cand = cand.withColumn("_p", F.concat(F.col("cand"), F.lit(": "), F.col("text")))
    ann = annotate.annotate(cand, "_p", responders.StubStyleResponder("sample"), ["index", "cand"])
    pairs = (ann.groupBy("index").pivot("cand", ["a", "b"]).agg(F.first("reply"))
             .select("index", F.col("a").alias("response_a"), F.col("b").alias("response_b")))
    return pairs.where(F.col("response_a").isNotNull() & F.col("response_b").isNotNull())


@register("k6_error_table", f"""
SELECT item_id AS index, 'TransientError: permanent failure for prompt ' || substr(md5({_story_prompt_sql('text')}), 1, 8)
         AS error,
       left({_story_prompt_sql('text')}, 200) AS preview
FROM benchmark WHERE {_h_sql(_story_prompt_sql('text'))} % 16 = 0""")
def q_k6(spark, d):
    """The resumable job's second output: failures with a 200-character
    preview of the prompt (written to, and read back from, the shared folder)."""
    from corpusforge.session import scratch_path

    items = table(spark, d, "benchmark").withColumnRenamed("item_id", "doc_id")
    sp = prompts.story_prompts(items, "doc_id", "text").select("index", "prompt")
    out, err = scratch_path(spark, "k6-out"), scratch_path(spark, "k6-err")
    annotate.run_resumable(sp, "prompt", responders.StubPairResponder(), ["index"], out, err)
    schema = "index long, error string, attempts int, preview string"
    return spark.read.schema(schema).json(err).select("index", "error", "preview")


# ------------------------------------------- jobs answered from conversations

JOB_PIECES = 8


def _reply_job(spark, d):
    """Every user turn asks; the assistant turn after it answers (equi-join)."""
    turns = table(spark, d, "conversations")
    todo = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    replies = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), "text")
    return todo, joblog.replies_from(replies, ["conv_id", "turn"], "text")


_JOB_SQL = """
SELECT u.conv_id, u.turn, a.text AS reply,
       CAST('0x' || substr(md5(concat_ws(':', CAST(u.conv_id AS VARCHAR), CAST(u.turn AS VARCHAR))), 1, 15) AS BIGINT) % 8 AS piece
FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'"""


@register("k7_job_progress", f"""
SELECT CAST(piece AS INTEGER) AS piece, count(reply) AS n_ok, count(*) - count(reply) AS n_error,
       CAST(sum(count(*)) OVER (ORDER BY piece) AS BIGINT) AS done
FROM ({_JOB_SQL}) GROUP BY piece""")
def q_k7(spark, d):
    from corpusforge.session import scratch_path

    todo, answer = _reply_job(spark, d)
    log = joblog.run_job(todo, answer, ["conv_id", "turn"], scratch_path(spark, "k7-job"), JOB_PIECES, 1)
    return log.select(F.element_at(F.split("piece", "-"), -1).cast("int").alias("piece"), "n_ok", "n_error", "done")


@register("l4_resume_half_filled", f"""
SELECT conv_id, turn, reply, CASE WHEN reply IS NULL THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN piece < 4 AND reply IS NOT NULL THEN 1 ELSE 2 END AS run
FROM ({_JOB_SQL})""")
def q_l4(spark, d):
    """A run that ends half-way, then one over the same rows: answers of the first
    run stay, its failures and all other rows are asked by the second."""
    from corpusforge.session import scratch_path

    todo, answer = _reply_job(spark, d)
    job, keys = scratch_path(spark, "l4-job"), ["conv_id", "turn"]
    joblog.run_job(todo, answer, keys, job, JOB_PIECES, 1, stop_after=JOB_PIECES // 2)
    first = [r["piece"] for r in joblog.progress(spark, job).collect()]           # 4 names
    joblog.run_job(todo, answer, keys, job, JOB_PIECES, 1)
    schema = answer(todo.limit(0)).schema
    rows = joblog.answers(spark, job, schema).unionByName(joblog.errors(spark, job, schema, keys))
    mine = F.when(F.col("piece").isin(first) & (F.col("status") == "ok"), 1).otherwise(2)
    return rows.select("conv_id", "turn", "reply", "status", mine.alias("run"))
