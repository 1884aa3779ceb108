"""Loss and preference metrics over scored tables (M1-M8).

Input is a per-token score table ``(model, example_id, side, pos, label,
logp)`` from any scorer; networks are not run here.  Every metric is a
grouped aggregate (partial + final, so hot groups aggregate map-side) or a
prefix sum through X1 buckets; no window holds a whole run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import IGNORE_INDEX
from corpusforge.operators.order import global_position


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def softplus(x: Column) -> Column:
    """Numerically stable ``log(1 + exp(x))``; finite for |x| = 1000."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def sequence_logprob(scored: DataFrame, keys: Sequence[str] = ("model", "example_id", "side"),
                     ignore: int = IGNORE_INDEX) -> DataFrame:
    """M1: sum of ``logp`` over tokens whose label is not ``ignore``;
    a sequence with no scored token sums to 0 (not NULL)."""
    return scored.groupBy(*keys).agg(
        F.sum(F.when(F.col("label") != ignore, F.col("logp")).otherwise(F.lit(0.0))).alias("seq_logp"),
        F.count(F.when(F.col("label") != ignore, 1)).alias("n_scored"))


def dpo_example_metrics(seq: DataFrame, beta: float = 0.1, key: str = "example_id",
                        policy: str = "policy", reference: str = "reference") -> DataFrame:
    """M2 per example: z = beta*((pi_c - pi_r) - (rho_c - rho_r)),
    loss = softplus(-z), correct = z > 0 (strict), rewards and margin.

    The four log-probs are gathered with conditional sums (one aggregate, no
    pivot of unknown width)."""
    def pick(model, side):
        return F.sum(F.when((F.col("model") == model) & (F.col("side") == side), F.col("seq_logp")))
    g = seq.groupBy(key).agg(pick(policy, "chosen").alias("pi_c"), pick(policy, "rejected").alias("pi_r"),
                             pick(reference, "chosen").alias("ref_c"), pick(reference, "rejected").alias("ref_r"))
    b = F.lit(float(beta))
    z = b * ((F.col("pi_c") - F.col("pi_r")) - (F.col("ref_c") - F.col("ref_r")))
    g = g.withColumn("z", z)
    return g.select(
        key, "z",
        softplus(-F.col("z")).alias("loss"),
        (F.col("z") > 0).cast("double").alias("correct"),
        (b * (F.col("pi_c") - F.col("ref_c"))).alias("chosen_reward"),
        (b * (F.col("pi_r") - F.col("ref_r"))).alias("rejected_reward"),
    ).withColumn("margin", F.col("chosen_reward") - F.col("rejected_reward"))


def dpo_summary(per_example: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """M2 aggregate: mean loss, accuracy, rewards and margin."""
    return per_example.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg("loss").alias("loss"), F.avg("correct").alias("accuracy"),
        F.avg("chosen_reward").alias("chosen_reward"), F.avg("rejected_reward").alias("rejected_reward"),
        F.avg("margin").alias("margin"))


def masked_mean_ce(tokens: DataFrame, group: Sequence[str], ce: str = "ce", mask: str = "mask") -> DataFrame:
    """M3: ``sum(ce*mask) / (sum(mask) + 1e-8)`` per group; all-masked -> 0."""
    return tokens.groupBy(*group).agg(
        (F.sum(F.col(ce) * F.col(mask)) / (F.sum(mask) + F.lit(1e-8))).alias("masked_ce"),
        F.sum(mask).alias("n_scored"))


def mean_ce_ignoring(tokens: DataFrame, group: Sequence[str], ce: str = "ce", label: str = "label",
                     ignore_value: int = IGNORE_INDEX) -> DataFrame:
    """M4: mean cross-entropy over tokens whose label is not ``ignore_value``
    (-100 for shifted labels, 0 = pad for the plain LM loss)."""
    return tokens.groupBy(*group).agg(
        F.avg(F.when(F.col(label) != ignore_value, F.col(ce))).alias("mean_ce"),
        F.count(F.when(F.col(label) != ignore_value, 1)).alias("n_kept"))


def epoch_metric(batches: DataFrame, group: Sequence[str], batch_col: str = "batch_id",
                 value: str = "loss") -> DataFrame:
    """M5: the reference's epoch loss is the **mean of batch means** (a short
    last batch weighs as much as a full one); the row-weighted mean is
    reported beside it."""
    per_batch = batches.groupBy(*group, batch_col).agg(F.avg(value).alias("_bm"), F.count(F.lit(1)).alias("_bn"),
                                                       F.sum(value).alias("_bs"))
    return per_batch.groupBy(*group).agg(
        F.avg("_bm").alias("mean_of_batch_means"),
        (F.sum("_bs") / F.sum("_bn")).alias("row_weighted_mean"),
        F.count(F.lit(1)).alias("n_batches"), F.sum("_bn").alias("n_rows"))


def best_epoch(epochs: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "val_loss") -> DataFrame:
    """M6: per run, the epoch with the lowest metric; strict ``<`` in the
    reference means the first of equal values wins (lowest epoch)."""
    return epochs.groupBy(run).agg(
        F.min_by(F.col(epoch), F.struct(F.col(metric), F.col(epoch))).alias("best_epoch"),
        F.min(metric).alias(f"best_{metric}"))


def mark_improvements(epochs: DataFrame, run: str = "run", epoch: str = "epoch",
                      metric: str = "val_loss") -> DataFrame:
    """M6 running form: ``is_best`` when the metric is strictly below every
    earlier epoch of the run.  The window spans one run's epochs only."""
    w = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.min(metric).over(w)
    return epochs.withColumn("is_best", prev.isNull() | (F.col(metric) < prev))


def running_mean(df: DataFrame, group: Sequence[str], order_cols: Sequence[str], bucket: Column,
                 value: str = "loss", bucket_bound: int = 16 ** 3, partition_fanout: int = 1) -> DataFrame:
    """M7: cumulative mean of ``value`` by step within ``group``.

    A prefix sum through X1's buckets: the window runs per (group, bucket),
    never over a whole run, so one long run is spread over many tasks.
    """
    d = global_position(df, order_cols, bucket, partition_cols=list(group), sums={"v": F.col(value)},
                        pos_col="step", total_col="n_steps", bucket_bound=bucket_bound,
                        partition_fanout=partition_fanout)
    return d.withColumn("running_mean", (F.col("v_offset") + F.col(value)) / (F.col("step") + 1))


def every_nth(df: DataFrame, step_col: str, n: int) -> DataFrame:
    """M8: rows whose step is a multiple of ``n`` (checkpoint/log cadence)."""
    return df.where(F.col(step_col) % F.lit(n) == 0)
