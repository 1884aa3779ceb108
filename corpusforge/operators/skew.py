"""Joins of many rows with the one row per key of a statistics table, where a
few keys may hold a large part of all rows.

A key is hot when it holds more than ``1 / (2 x shuffle partitions)`` of all
rows, so there are at most ``2 x partitions`` hot keys and their list may be
broadcast whatever the table.  Rows of a hot key are salted by a hash of
another column, and only its statistics row is repeated per salt; all other
rows take salt 0 and nothing is repeated for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, key: str, n: str, min_rows: int = 100_000) -> DataFrame:
    """``key, _salts`` of the hot keys of a table of row counts per key."""
    # at most 2 x partitions rows: each holds more than its share of the total
    share = counts.agg(F.sum(n)).scalar() / F.lit(2.0 * _partitions(counts))
    limit = F.greatest(share, F.lit(float(min_rows)))
    return counts.where(F.col(key).isNotNull() & (F.col(n) > limit)).select(
        key, F.ceil(F.col(n) / limit).cast("int").alias("_salts"))


def join_hot(rows: DataFrame, stats: DataFrame, key: str, hot: DataFrame, by: Column, how: str = "inner") -> DataFrame:
    """``rows.join(stats, key)`` with the rows of hot keys spread by a hash of
    ``by``; ``stats`` has one row per key."""
    hot = F.broadcast(hot)
    # null keys match nothing, and must not meet in one task either
    salts = F.when(F.col(key).isNull(), F.lit(_partitions(rows))).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = rows.join(hot, key, "left").withColumn(SALT, F.pmod(F.xxhash64(by), salts).cast("int"))
    each = stats.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))))
    return salted.drop("_salts").join(each.drop("_salts"), [key, SALT], how).drop(SALT)
