"""Prompt construction for annotation jobs.

Items meet their seed rows in equi-joins on a hashed or arithmetic key; no
cross join is formed.  The fixed prompt tables are tiny and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import fill_template, prefix, seeded_hash_mod
from corpusforge.sources import seeds

# Neutral default templates; callers pass their own.
STORY_TEMPLATE = "### Text\n{story}\n### Instruction that this text answers\n"
TASK_TEMPLATE = "### Language\n{name}\n### Source\n{topic}\n### Question and answer as JSON\n"


def story_prompts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_chars: int | None = None, template: str = STORY_TEMPLATE) -> DataFrame:
    """The annotation prompt around the text, or (P3) around its first
    ``max_chars`` characters; the full text stays in the row as the response."""
    story = F.col(text_col) if max_chars is None else prefix(text_col, max_chars)
    return docs.select(F.col(id_col).alias("index"),
                       fill_template(template, story=story).alias("prompt"),
                       F.col(text_col).alias("response"))


def task_grid(items: DataFrame, id_col: str, seed: int = 42, template: str = TASK_TEMPLATE,
              category_col: str = "lang", topic_col: str = "source") -> DataFrame:
    """Each item draws a category and a topic independently (with
    replacement) from a seeded md5 hash.  Categories and topics are the
    distinct values of two columns of the given table (S8)."""
    cats = seeds.numbered_values(items, category_col, "category_id", "category")
    tops = seeds.numbered_values(items, topic_col, "topic_id", "topic")
    d = items.select(F.col(id_col).alias("index"),
                     seeded_hash_mod(cats.count(), seed, id_col, salt="c").alias("category_id"),
                     seeded_hash_mod(tops.count(), seed, id_col, salt="t").alias("topic_id"))
    d = d.join(cats, on="category_id").join(tops, on="topic_id")
    prompt = fill_template(template, name=F.col("category"), topic=F.col("topic"))
    return d.select("index", "category", "topic", prompt.alias("prompt"))


def prompt_variations(items: DataFrame, id_col: str, compat: bool = False) -> DataFrame:
    """P13 + P16: item ``i`` takes base prompt ``i % 30`` and variation
    ``(i div 30) % 5`` (all 150 combinations).  ``compat=True`` uses the
    reference's ``i % 5``, which only ever yields 30 distinct prompts."""
    spark = items.sparkSession
    nb, nv = len(seeds.BASE_PROMPTS), len(seeds.VARIATIONS)
    i = F.col(id_col)
    var = F.pmod(i, F.lit(nv)) if compat else F.pmod(F.floor(i / nb), F.lit(nv))
    d = items.select(i.alias("index"), F.pmod(i, F.lit(nb)).cast("int").alias("base_id"),
                     var.cast("int").alias("variation_id"))
    d = (d.join(F.broadcast(seeds.base_prompts_df(spark)), on="base_id")
          .join(F.broadcast(seeds.variations_df(spark)), on="variation_id"))
    parts = F.split(F.col("template"), r"\{p\}", 2)
    # only the polite form lower-cases the prompt (P16); the others keep it as it is
    base = F.when(F.col("polite"), F.lower(F.col("base"))).otherwise(F.col("base"))
    prompt = F.concat(F.get(parts, 0), base, F.coalesce(F.get(parts, 1), F.lit("")))
    return d.select("index", "base_id", "variation_id", prompt.alias("prompt"))
