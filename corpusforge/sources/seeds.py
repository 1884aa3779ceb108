"""Seed tables (S8).  Task categories and topics are the distinct values of
given columns; the base prompts and their five variations are our own, with
the shape that the preference job needs (30 prompts, 5 variations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values (our own wording): base prompts for preference generation.
BASE_PROMPTS = [
    "Describe a rainy afternoon", "Explain how a bicycle gear works", "Tell me about bread making",
    "Give tips for a first garden", "Describe the night sky", "Explain why rivers bend",
    "Suggest a weekend hobby", "Describe a busy market", "Explain how bees find flowers",
    "Tell me about old lighthouses", "Give advice for learning chess", "Describe a mountain trail",
    "Explain how clocks keep time", "Suggest ways to save water", "Describe a winter morning",
    "Explain what a volcano is", "Tell me about paper kites", "Give tips for writing letters",
    "Describe a quiet library", "Explain how bridges carry weight", "Suggest a simple recipe",
    "Describe a forest in autumn", "Explain how maps are drawn", "Tell me about train journeys",
    "Give tips for painting outdoors", "Describe a seaside town", "Explain how insects see",
    "Suggest a game for a rainy day", "Describe a museum visit", "Explain how recycling helps",
]

# Fixed values (our own wording): variation templates; {p} is the base prompt, lower-cased in the polite form only.
VARIATIONS = [
    "{p}.", "Please {p}.", "In a few sentences, {p}.", "For a child, {p}.", "Briefly, {p}.",
]


def numbered_values(df: DataFrame, col: str, id_name: str, name: str) -> DataFrame:
    """(id, value) of the distinct values of a column, numbered in order; a
    table without the column has the single value ``any``."""
    if col not in df.columns:
        return df.sparkSession.createDataFrame([(0, "any")], f"{id_name} long, {name} string")
    values = df.select(F.col(col).cast("string").alias(name)).where(F.col(name).isNotNull()).distinct()
    return values.select((F.row_number().over(Window.orderBy(name)) - 1).cast("long").alias(id_name), name)


def base_prompts_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(BASE_PROMPTS)), "base_id int, base string")


def variations_df(spark: SparkSession) -> DataFrame:
    rows = [(i, v, v.startswith("Please")) for i, v in enumerate(VARIATIONS)]
    return spark.createDataFrame(rows, "variation_id int, template string, polite boolean")
