"""Preference rows and preference-pair assembly.

Token rows follow the reference: prompt = ``[bos, user] + P + [assistant]``,
responses end in ``<eos>``; responses are cut to the budget left by the
prompt (keeping a final ``<eos>``), sequences are padded/cut to M and labels
are -100 over the prompt and the padding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import (ASSISTANT_ID, BOS_ID, EOS_ID, IGNORE_INDEX, PAD_ID,
                                        USER_ID, preference_columns, valid_pair)
from corpusforge.operators.order import global_position, hex_bucket, hex_digits_for, order_key
from corpusforge.operators.sft import pad_to
from corpusforge.session import cut_lineage


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prompt_tokens(p_ids: Column | str) -> Column:
    """G1: ``[bos, user] + P + [assistant]``."""
    return F.concat(F.array(F.lit(BOS_ID), F.lit(USER_ID)), _c(p_ids), F.array(F.lit(ASSISTANT_ID)))


def response_tokens(r_ids: Column | str) -> Column:
    """G1: ``R + [eos]``."""
    return F.concat(_c(r_ids), F.array(F.lit(EOS_ID)))


def fit_response(resp: Column, prompt_len: Column, max_length: int) -> Column:
    """Budget ``m = M - len(prompt)``; if ``len(r) > m``: ``r[:m-1] + [eos]``.

    For ``m <= 0`` the reference's slice bound turns negative; the final
    arrays are the same either way because G3 cuts at M inside the prompt, so
    here the response is simply emptied.
    """
    m = F.lit(max_length) - prompt_len
    cut = F.concat(F.slice(resp, 1, F.greatest(m - 1, F.lit(0))), F.array(F.lit(EOS_ID)))
    return (F.when(m <= 0, F.array().cast("array<int>"))
            .when(F.size(resp) > m, cut).otherwise(resp))


def preference_rows(df: DataFrame, prompt_ids: str, chosen_ids: str, rejected_ids: str,
                    max_length: int = 512, label_mode: str = "response",
                    eos_on_truncate: bool = True) -> DataFrame:
    """Four arrays of length M plus ``prompt_overflow``.

    ``label_mode='all'`` with ``eos_on_truncate=False`` is the single-string
    variant (G5): the whole template is cut at M without forcing ``<eos>``
    and only padding is ignored.
    """
    M = max_length
    p = prompt_tokens(prompt_ids)
    d = df.withColumn("_p", p).withColumn("_plen", F.size("_p"))
    out = [*df.columns, (F.col("_plen") >= M).alias("prompt_overflow")]
    for side, ids in (("chosen", chosen_ids), ("rejected", rejected_ids)):
        r = response_tokens(ids)
        if eos_on_truncate:
            r = fit_response(r, F.col("_plen"), M)
        full = F.concat(F.col("_p"), r)
        if label_mode == "response":
            labels = F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.col("_plen")), r)
        elif label_mode == "all":
            labels = full
        else:
            raise ValueError(label_mode)
        out += [pad_to(full, M, PAD_ID).alias(f"{side}_input_ids"),
                pad_to(labels, M, IGNORE_INDEX).alias(f"{side}_labels")]
    return d.select(*out)


def derive_response_pairs(pairs: DataFrame, key: str = "index", seed: int = 42) -> DataFrame:
    """Stand-in for G6 over single-reply data (FIXTURES B): ``response_a`` is
    the pair's own reply, ``response_b`` the reply of the next pair in the
    seeded md5 order (the last wraps to the first).

    An equi-join on the unique position: no key is hot.
    """
    n = pairs.count()
    d = pairs.select(key, "instruction", "response").withColumn("order_key", order_key(seed, key))
    digits = hex_digits_for(n)
    # positions are read by both sides of the self-join: computed once
    pos = cut_lineage(global_position(d, ["order_key", key], hex_bucket("order_key", digits),
                                      bucket_bound=16 ** digits))
    nxt = pos.select(((F.col("pos") - 1 + F.col("n_total")) % F.col("n_total")).alias("pos"),
                     F.col("response").alias("response_b"))
    out = (pos.join(nxt, on="pos", how="inner")
           .select(key, F.col("instruction").alias("prompt"), F.col("response").alias("response_a"),
                   "response_b"))
    return cut_lineage(out)  # read again by the verdicts and the preference join


def stub_verdict(key: Column | str) -> Column:
    """Deterministic judge stand-in: ``A`` when the low bit of the first md5
    hex digit of the key is 0, else ``B``."""
    first = F.substring(F.md5(_c(key).cast("string")), 1, 1)
    bit = (F.instr(F.lit("0123456789abcdef"), first) - 1) % 2
    return F.when(bit == 0, F.lit("A")).otherwise(F.lit("B"))


def dedupe_verdicts(verdicts: DataFrame, key: str = "index", verdict_col: str = "verdict",
                    order_col: str = "verdict_id") -> DataFrame:
    """G8 helper: at most one verdict per key (the lowest ``order_col``).

    ``min_by`` aggregates map-side, so a key with many verdicts stays cheap.
    """
    return verdicts.groupBy(key).agg(F.min_by(verdict_col, order_col).alias(verdict_col))


def preference_join(responses: DataFrame, verdicts: DataFrame, key: str = "index") -> DataFrame:
    """G8 + P10/P11 + P12: valid response pairs joined to parsed verdicts,
    projected to ``prompt, chosen, rejected``; unparsed verdicts give no row.
    Of several verdicts for a key one counts: the lowest ``verdict_id``, or the
    smallest verdict where there is no such column."""
    order_col = "verdict_id" if "verdict_id" in verdicts.columns else "verdict"
    verdicts = dedupe_verdicts(verdicts, key, "verdict", order_col)
    valid = responses.where(valid_pair("response_a", "response_b"))
    j = valid.join(verdicts.where(F.col("verdict").isin("A", "B")), on=key, how="inner")
    return j.select(key, "prompt", *preference_columns("verdict", "response_a", "response_b"))
