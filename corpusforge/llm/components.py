"""Connected components of an edge table by alternating large-star and
small-star steps.  Every step is one shuffle with a map-side minimum; the edge
table is written to the shared folder between rounds, so nothing is collected
and lost executors cost one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import written
from corpusforge.operators.skew import hot_keys, join_hot


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Per u: link its (strictly larger / smaller-or-equal) neighbours to the
    smallest of u and its neighbours.  The minimum comes from a grouped
    aggregate joined back with hubs salted, so a hub's neighbours never meet in
    one task."""
    found = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    least = found.select("u", F.least("u", "m").alias("m"))
    j = join_hot(pairs, least, "u", hot_keys(found, "u", "n"), F.col("v"))
    if larger:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.where("m <> v").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.where("u <> m").select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """edges (u long, v long) -> (node, component): smallest id reachable, for
    every node that has an edge.  Self loops, nulls and repeats are ignored."""
    e = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "cc")
    last = None
    for _ in range(max_rounds):
        large = _star(_both_ways(e), True)
        e = written(_star(large, False), "cc")
        # an edge set of stars only is a fixed point
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == last:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = tuple(now)
    raise RuntimeError("connected_components did not settle")


