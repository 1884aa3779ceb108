"""Candidate ranking per context (N1-N7), from the samplers' selection rules.

Input ``candidates(context_id, item_id, score)``.  A context may be hot
(think of the word "the" in a bigram table), so:

* per-context statistics (sum of exponentials, k-th value) are grouped aggregates,
  combined map-side, and joined back once with hot contexts salted (`skew`);
* top-k runs in two phases: a top-k per (context, salt) where the salt
  spreads a hot context over many tasks, then a top-k over at most
  ``k * salts`` survivors per context.  That is exact for ``row_number``
  and, for ``rank`` with ties, through the k-th value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import EOS_ID
from corpusforge.operators.skew import hot_keys, join_hot

CTX, ITEM, SCORE = "context_id", "item_id", "score"
DEFAULT_SALTS = 16


def _salted(df: DataFrame, salts: int) -> DataFrame:
    return df.withColumn("_salt", F.pmod(F.xxhash64(F.col(ITEM)), F.lit(salts)))


#: scores are summed per step of this size, relative to the step
STEP = 32.0


def softmax(df: DataFrame, temperature: float = 1.0, score: str = SCORE, out: str = "prob") -> DataFrame:
    """``exp(s/T - max) / sum(exp(s/T - max))`` per context, with one
    aggregate over the rows and one join back.

    The sum does not need the maximum first: exponentials are summed per
    (context, ``floor(s / T / STEP)``) relative to the step, where they stay
    below ``e ** STEP``, and a context's few steps are then added relative to its
    highest one."""
    y = F.col(score) / float(temperature)
    step = F.floor(F.greatest(F.least(y / STEP, F.lit(1e9)), F.lit(-1e9)))
    steps = df.groupBy(CTX, step.alias("_s")).agg(F.sum(F.exp(y - step * STEP)).alias("_z"), F.count(F.lit(1)).alias("_n"))
    top = steps.groupBy(CTX).agg(F.max("_s").alias("_top"))
    stats = steps.join(top, CTX).groupBy(CTX).agg(
        F.max("_top").alias("_top"), F.sum(F.col("_z") * F.exp((F.col("_s") - F.col("_top")) * STEP)).alias("_z"),
        F.sum("_n").alias("_n"))
    d = join_hot(df, stats.select(CTX, "_top", "_z"), CTX, hot_keys(stats, CTX, "_n"), F.col(ITEM))
    return d.withColumn(out, F.exp(y - F.col("_top") * STEP) / F.col("_z")).drop("_top", "_z")


def top_k_exact(df: DataFrame, k: int, score: str = SCORE, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Exactly ``min(k, n)`` items per context by (score desc, item asc);
    adds ``rank_in_context`` (1-based)."""
    order = [F.col(score).desc(), F.col(ITEM).asc()]
    local = _salted(df, salts).withColumn(
        "_r", F.row_number().over(Window.partitionBy(CTX, "_salt").orderBy(*order))).where(F.col("_r") <= k)
    ranked = local.withColumn("rank_in_context", F.row_number().over(Window.partitionBy(CTX).orderBy(*order)))
    return ranked.where(F.col("rank_in_context") <= k).drop("_salt", "_r")


def kth_value(df: DataFrame, k: int, score: str = SCORE, salts: int = DEFAULT_SALTS) -> DataFrame:
    """The k-th largest score per context (or the smallest if fewer than k)."""
    top = top_k_exact(df, k, score, salts)
    return top.groupBy(CTX).agg(F.min(score).alias("_kth"))


def top_k_with_ties(df: DataFrame, k: int, temperature: float = 1.0, score: str = SCORE,
                    salts: int = DEFAULT_SALTS) -> DataFrame:
    """Keep items scoring at least the k-th value (ties survive, i.e.
    ``rank() <= k``), then renormalise the softmax over the survivors.

    Everything but the items comes from the counts per (context, score), which
    combine map-side: the k-th value and the sum over all survivors, ties
    included, need at most ``k`` distinct scores of a context."""
    counts = df.where(F.col(score).isNotNull()).groupBy(CTX, score).agg(F.count(F.lit(1)).alias("_n"))
    best = F.col(score).desc()
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64(F.col(score)), F.lit(salts)))
    local = salted.withColumn("_r", F.row_number().over(Window.partitionBy(CTX, "_salt").orderBy(best))).where(F.col("_r") <= k)
    run = Window.partitionBy(CTX).orderBy(best).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = local.withColumns({"_before": F.sum("_n").over(run) - F.col("_n"), "_mx": F.max(score).over(run)}).where(
        F.col("_before") < k)
    t = float(temperature)
    stats = kept.groupBy(CTX).agg(F.min(score).alias("_kth"), F.max("_mx").alias("_mx"),
                                  F.sum(F.col("_n") * F.exp(F.col(score) / t - F.col("_mx") / t)).alias("_z"))
    hot = hot_keys(counts.groupBy(CTX).agg(F.sum("_n").alias("_n")), CTX, "_n")
    d = join_hot(df, stats, CTX, hot, F.col(ITEM)).where(F.col(score) >= F.col("_kth"))
    return d.withColumn("prob", F.exp(F.col(score) / t - F.col("_mx") / t) / F.col("_z")).drop("_kth", "_mx", "_z")


def nucleus(df: DataFrame, k: int = 100, top_p: float = 0.9, temperature: float = 1.0,
            score: str = SCORE, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Probabilities from the *full* softmax, restricted to the exact
    top-k, sorted descending; keep while the running sum is <= p, and always
    the first.  The item whose running sum crosses p is dropped (the
    reference's rule).  The window spans at most k rows per context."""
    probs = softmax(df, temperature, score, "prob")
    top = top_k_exact(probs.withColumn("_sp", F.col("prob")), k, "_sp", salts).drop("_sp")
    w = Window.partitionBy(CTX).orderBy(F.col("rank_in_context")).rowsBetween(Window.unboundedPreceding, 0)
    top = top.withColumn("cum_prob", F.sum("prob").over(w))
    return top.where((F.col("cum_prob") <= F.lit(float(top_p))) | (F.col("rank_in_context") == 1))


def weighted_draw(df: DataFrame, seed: int = 0, prob: str = "prob") -> DataFrame:
    """One categorical draw per context with the Gumbel-max trick:
    ``argmax(log p - log(-log u))``.  ``u`` is uniform in (0, 1) from the
    first 13 hex digits of ``md5('<seed>:<context>:<item>')`` (portable to
    other engines); ``max_by`` aggregates map-side."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(CTX).cast("string"), F.col(ITEM).cast("string")))
    u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(16 ** 13)
    key = F.log(F.col(prob)) - F.log(-F.log(u))
    return (df.where(F.col(prob) > 0).withColumn("_g", key)
            .groupBy(CTX).agg(F.max_by(ITEM, "_g").alias("drawn_item")))


def cut_at_eos(ids: Column | str, eos: int = EOS_ID) -> Column:
    """Keep ids before the first ``eos`` (all if none)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    p = F.array_position(c, F.lit(eos))
    return F.when(p > 0, F.slice(c, 1, (p - 1).cast("int"))).otherwise(c)


def keep_last(ids: Column | str, n: int) -> Column:
    """The last ``n`` ids (right crop of the context)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.when(F.size(c) > n, F.slice(c, -n, n)).otherwise(c)


def bigram_candidates(words_df: DataFrame, words_col: str = "words") -> DataFrame:
    """Candidates from a corpus: context = word, item = next word,
    score = bigram count (aggregated map-side)."""
    w = F.col(words_col)
    pairs = F.arrays_zip(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                         F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))))
    ex = words_df.select(F.explode(pairs).alias("_p")).select(
        F.col("_p").getField("0").alias(CTX), F.col("_p").getField("1").alias(ITEM))
    return ex.groupBy(CTX, ITEM).agg(F.count(F.lit(1)).cast("double").alias(SCORE))
