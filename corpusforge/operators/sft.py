"""Instruction-tuning rows.

Row layout follows the reference: ``<bos><user> I <assistant> R <eos>``,
truncated keeping a final ``<eos>``, right-padded with ``<pad>`` (id 0),
shifted by one, and a loss mask that hides the instruction and the padding.
All steps are array expressions; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import ASSISTANT_ID, BOS_ID, EOS_ID, PAD_ID, USER_ID


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def chat_tokens(instr_ids: Column | str, resp_ids: Column | str) -> Column:
    """``[bos, user] + I + [assistant] + R + [eos]``."""
    return F.concat(F.array(F.lit(BOS_ID), F.lit(USER_ID)), _c(instr_ids), F.array(F.lit(ASSISTANT_ID)),
                    _c(resp_ids), F.array(F.lit(EOS_ID)))


def truncate_keep_eos(tokens: Column, max_length: int) -> Column:
    """longer than M -> first M-1 tokens + ``<eos>``."""
    return F.when(F.size(tokens) > max_length,
                  F.concat(F.slice(tokens, 1, max_length - 1), F.array(F.lit(EOS_ID)))).otherwise(tokens)


def pad_to(tokens: Column, length: int, pad: int = PAD_ID) -> Column:
    """Right-pad with ``pad`` and cut to exactly ``length``."""
    return F.slice(F.concat(tokens, F.array_repeat(F.lit(pad), length)), 1, length)


def sft_rows(df: DataFrame, instr_ids: str, resp_ids: str, max_length: int = 512,
             mask_instruction: bool = True) -> DataFrame:
    """Adds ``n_tokens`` (after truncation), ``instr_len``, ``truncated``,
    ``input_ids``, ``target_ids`` (M-1 each) and ``loss_mask`` (float)."""
    M = max_length
    full = chat_tokens(instr_ids, resp_ids)
    d = df.withColumn("_full_len", F.size(full)).withColumn("_tok", truncate_keep_eos(full, M))
    d = d.withColumn("instr_len", F.least(F.size(instr_ids) + 3, F.size("_tok")))
    d = d.withColumn("_pad", pad_to(F.col("_tok"), M))
    target = F.slice("_pad", 2, M - 1)
    cut = F.col("instr_len") - 1 if mask_instruction else F.lit(0)

    def mask(t, i):
        return F.when(i < cut, F.lit(0.0)).when(t == PAD_ID, F.lit(0.0)).otherwise(F.lit(1.0)).cast("float")

    return d.select(
        *df.columns,
        F.size("_tok").alias("n_tokens"),
        "instr_len",
        (F.col("_full_len") > M).alias("truncated"),
        F.slice("_pad", 1, M - 1).alias("input_ids"),
        target.alias("target_ids"),
        F.transform(target, mask).alias("loss_mask"),
    )


def sft_stats(rows: DataFrame, max_length: int) -> DataFrame:
    """mean/max length; ``at_or_over_max`` is the reference's "truncated"
    count (len >= M after truncation, so rows of exactly M count too);
    ``exact_max`` (exactly M without cutting) and ``truncated`` (cut) are
    reported apart.  Averages are NULL on empty input."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("n_tokens"), 6).alias("avg_len"),
        F.max("n_tokens").alias("max_len"),
        F.count(F.when(F.col("n_tokens") >= max_length, 1)).alias("at_or_over_max"),
        F.count(F.when((F.col("n_tokens") == max_length) & ~F.col("truncated"), 1)).alias("exact_max"),
        F.count(F.when(F.col("truncated"), 1)).alias("truncated"),
    )


#: turns of one conversation that a row key has room for
TURN_SPAN = 1 << 32


def turn_key(conv: str = "conv_id", turn: str = "turn") -> Column:
    """One number per (conversation, turn), in that order."""
    return F.col(conv) * F.lit(TURN_SPAN) + F.col(turn)


def chat_pairs(conversations: DataFrame) -> DataFrame:
    """every user turn paired with the directly following assistant turn.

    An equi-join on the unique ``(conv_id, turn)`` key: no conversation, however
    long, becomes one task's group.  ``index = conv_id * 2^32 + turn`` is unique
    for turns below 2^32.
    """
    users = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction"))
    replies = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    pairs = users.join(replies, on=["conv_id", "turn"], how="inner")
    return pairs.select(turn_key().alias("index"),
                        "conv_id", "turn", "instruction", "response")
