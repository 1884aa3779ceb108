"""Chat formatting with cumulative-snapshot collapse (DataFrame functions only).

A logged conversation is often saved after every turn.  Each turn gets a
128-bit hash of its place, role and text; the running XOR of these is the hash
of the prefix that ends there.  A conversation whose whole hash is among the
proper-prefix hashes of others is a snapshot of a longer one and leaves by an
anti-join; of equal conversations the smallest id stays.  The maximal ones are
rendered, one role header, text and end mark per turn.

Before the joins, prefix hashes are made distinct and equal conversations are
folded with map-side aggregation, so a first turn that a third of all
conversations share is one row.  Only a conversation's own turns meet in one
row, which is what rendering it needs.

Defined cases: a turn row that repeats exactly counts once; turns with one
number are ordered by role and text; null role or text is empty, a null turn
number sorts first, rows with a null id form one conversation with a null id
(smallest); other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import id_in, id_out, written

HEAD, MID, END = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, turns array<struct<turn, role, text>>) in order."""
    t = turns.select(id_in(id_col).alias("conv"), F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    return t.groupBy("conv").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def prefix_hashes(convs: DataFrame) -> DataFrame:
    """(conv, i, n, p1, p2): rolling hashes of the first i turns (i from 1) of n."""
    x = convs.select("conv", F.size("turns").alias("n"), F.posexplode("turns").alias("i", "t")).select(
        "conv", "n", (F.col("i") + 1).alias("i"),
        F.xxhash64("i", "t.role", "t.text").alias("h1"), F.xxhash64("t.text", F.lit("#"), "i", "t.role").alias("h2"))
    so_far = Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return x.select("conv", "i", "n", F.bit_xor("h1").over(so_far).alias("p1"), F.bit_xor("h2").over(so_far).alias("p2"))


def render(turns: str = "turns"):
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MID), t["text"], F.lit(END))), "")


def maximal_chats(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, n_turns, n_copies, chat): one row per maximal conversation."""
    convs = written(conversations(turns, id_col), "chats")
    pre = written(prefix_hashes(convs), "chat-prefixes")
    whole = (pre.where("i = n").groupBy("n", "p1", "p2")
             .agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies")))
    proper = pre.where("i < n").select(F.col("i").alias("n"), "p1", "p2").distinct()
    keep = whole.join(proper, ["n", "p1", "p2"], "left_anti").select("conv", "n_copies")
    return convs.join(keep, "conv").select(
        id_out("conv").alias(id_col), F.size("turns").cast("long").alias("n_turns"), "n_copies", render().alias("chat"))


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             count(*) OVER (PARTITION BY conv_id) AS n FROM t),
p AS (SELECT conv_id, i, n, md5(string_agg(md5(length(role) || ':' || role || text), ',')
             OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS h FROM r),
w AS (SELECT n, h, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE i = n GROUP BY n, h),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.i < p.n AND p.i = w.n AND p.h = w.h))
SELECT k.conv_id, k.n AS n_turns, k.n_copies,
       string_agg('<|' || r.role || '|>' || chr(10) || r.text || '<|end|>' || chr(10), '' ORDER BY r.i) AS chat
FROM k JOIN r ON r.conv_id = k.conv_id GROUP BY k.conv_id, k.n, k.n_copies"""
