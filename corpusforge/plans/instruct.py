"""Seeds -> instruction pairs -> SFT rows, and prompts -> candidate pairs ->
judged preferences -> preference rows (SURVEY 3.2 and 3.3).

The responder and judge are pluggable callables; replies are parsed with
built-in expressions and failures go to an error table.  Every table of
model replies is checkpointed once into the shared folder before it is read
twice, so no call is ever repeated by a recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import (fenced_payload, has_keys, parse_object, parse_verdict,
                                        strip_wrapping_quotes, valid_pair)
from corpusforge.operators import annotate, order, prefs, prompts, sft
from corpusforge.operators.annotate import Responder
from corpusforge.session import cut_lineage


def generate_pairs(items: DataFrame, id_col: str, responder: Responder, seed: int = 42,
                   **annotate_kwargs) -> tuple[DataFrame, DataFrame]:
    """P14 task grid -> P4 prompt -> L1 annotate -> P6/P7 parse.

    Returns ``(pairs, errors)``: ``pairs(index, category, topic, instruction,
    response)`` and ``errors(index, category, topic, error)`` (failed calls
    and replies without both keys)."""
    grid = prompts.task_grid(items, id_col, seed)
    # replies are staged once: both outputs read them, and a responder call
    # must not be repeated by a recomputation
    ann = cut_lineage(annotate.annotate(grid, "prompt", responder, ["index"], carry=["category", "topic"],
                                        **annotate_kwargs))
    payload = fenced_payload("reply")
    ok = ann.where((F.col("status") == "ok") & has_keys(payload, ["instruction", "response"]))
    parsed = ok.select("index", "category", "topic", parse_object(payload, ["instruction", "response"]).alias("p"))
    pairs = parsed.select("index", "category", "topic", strip_wrapping_quotes("p.instruction").alias("instruction"),
                          F.col("p.response").alias("response"))
    errors = ann.where((F.col("status") != "ok") | ~has_keys(payload, ["instruction", "response"])).select(
        "index", "category", "topic",
        F.coalesce(F.col("error"), F.lit("reply without instruction/response")).alias("error"))
    return pairs, errors


def split_rows(rows: DataFrame, id_col: str, val_ratio: float = 0.1, seed: int = 42,
               validation: DataFrame | None = None) -> DataFrame:
    """rows with a ``split`` label.  With a validation set of its own (rows
    made from a second file) the training rows are all kept and nothing is
    shuffled; otherwise the exact random split (D7), which reads the rows twice."""
    if validation is not None:
        return rows.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    return order.random_split(cut_lineage(rows), id_col, val_ratio, seed)


def sft_dataset(pairs: DataFrame, encode, max_length: int = 512, val_ratio: float = 0.1,
                seed: int = 42, validation: DataFrame | None = None) -> DataFrame:
    """S1 schema -> F1-F5 -> F7: SFT rows with a ``split`` label; ``validation``
    holds the pairs of a separate validation file.

    ``encode`` is a Column function ``text -> array<int>`` (BPE or word)."""
    def rows(p: DataFrame) -> DataFrame:
        ids = p.select("index", encode("instruction").alias("i_ids"), encode("response").alias("r_ids"))
        return sft.sft_rows(ids, "i_ids", "r_ids", max_length)
    return split_rows(rows(pairs), "index", val_ratio, seed, None if validation is None else rows(validation))


def response_pairs(prompts_df: DataFrame, id_col: str, prompt_col: str, responder: Responder, n: int,
                   seed: int = 42, **annotate_kwargs) -> DataFrame:
    """D3 sample -> G6 two candidates per prompt -> P12 validity filter."""
    sample = order.exact_n_sample(prompts_df.select(F.col(id_col).alias("index"), prompt_col), "index", n, seed)
    cand = sample.select("index", F.col(prompt_col).alias("prompt"),
                         F.explode(F.array(F.lit("a"), F.lit("b"))).alias("cand"))
    cand = cand.withColumn("_p", F.concat(F.col("cand"), F.lit(": "), F.col("prompt")))
    ann = annotate.annotate(cand, "_p", responder, ["index", "cand"], carry=["prompt"], **annotate_kwargs)
    wide = (ann.where(F.col("status") == "ok").groupBy("index", "prompt").pivot("cand", ["a", "b"])
            .agg(F.first("reply")))
    wide = wide.select("index", "prompt", F.col("a").alias("response_a"), F.col("b").alias("response_b"))
    return cut_lineage(wide).where(F.col("response_a").isNotNull() & F.col("response_b").isNotNull()
                      & valid_pair("response_a", "response_b"))


# Neutral default; callers pass their own.
JUDGE_TEMPLATE = "### Prompt\n{prompt}\n### A\n{a}\n### B\n{b}\n### Better one, A or B\n"


def judge_preferences(pairs: DataFrame, judge: Responder, **annotate_kwargs) -> tuple[DataFrame, DataFrame]:
    """P3/P4 judge prompt -> L1 -> P10 parse -> P11/G8 projection.

    Returns ``(preferences, unparsed)``; unparsed verdicts produce no row (and
    are retried on the next run, as in the reference)."""
    from corpusforge.functions.text import fill_template

    prompt = fill_template(JUDGE_TEMPLATE, prompt=F.col("prompt"), a=F.col("response_a"),
                           b=F.col("response_b"))
    asked = pairs.withColumn("_judge", prompt)
    ann = cut_lineage(annotate.annotate(asked, "_judge", judge, ["index"],
                                        carry=["prompt", "response_a", "response_b"], **annotate_kwargs))
    verdicts = ann.select("index", parse_verdict("reply").alias("verdict"))
    prefs_df = prefs.preference_join(pairs, verdicts, "index")
    unparsed = ann.join(verdicts.where(F.col("verdict").isNull()), on="index", how="left_semi").select(
        "index", "status", "reply", "error")
    return prefs_df, unparsed


def preference_dataset(preferences: DataFrame, encode, max_length: int = 512, val_ratio: float = 0.1,
                       seed: int = 42) -> DataFrame:
    """G1-G4 rows with a ``split`` label."""
    ids = preferences.select("index", encode("prompt").alias("p_ids"), encode("chosen").alias("c_ids"),
                             encode("rejected").alias("r_ids"))
    rows = cut_lineage(prefs.preference_rows(ids, "p_ids", "c_ids", "r_ids", max_length))
    return order.random_split(rows, "index", val_ratio, seed)
