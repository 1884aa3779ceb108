"""Spelling variant grouping by composing a vocabulary acceptor with itself.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  Words of at least five code points that are near share their
first two or their last two code points, so the vocabulary is cut by the state
an acceptor reaches after them: once by the first code points of the words,
once by the last ones of the reversed words.  A part's words become a minimised
acceptor (built from the sorted words, equal right languages shared); it is
composed with a one-edit transducer and with itself: before the edit both sides
are in one state, the edit leaves it over two different arcs (replaced) or over
one arc on one side (deleted), and after it both sides follow equal arcs.  What
two states accept in common is found once per pair of states.  The accepted
pairs of a part are listed; reversed parts list those whose first two code
points differ, so no pair comes twice.

A part of more than ``limit`` words (a prefix that a third of all words share)
is not composed whole: its state is replaced by the states one code point
further on, again while they are too large.  Pairs that part right at a replaced
state meet by an equi-join on the rest of the word without that code point, at
most one word per code point of the alphabet (and one without) in each group.

Counting is one aggregation with map-side sums; chains of forms are followed by
pointer doubling (a form has at least twice the occurrences, so chains are
short).

Defined cases: null or empty text has no word; a null id is the empty string in
the hashed key; a text in repeated rows counts each time; other columns are
ignored, whatever their names; a text without letters and an empty table give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import group_starts, sorted_runs, written

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARED = 2                # near words share their first or last two code points
LEAST = 2 * SHARED + 1    # which needs this many code points


def words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", damage: int | None = 97,
          min_length: int = LEAST, min_count: int = 3) -> DataFrame:
    """(word, n): lower-cased letter runs, one code point taken from those
    whose key's crc32 ``damage`` divides (None: from none)."""
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), 0))
    t = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("w"))
    # lower() would change accented letters too; runs of ASCII letters only are by far the most
    ascii_only = F.octet_length("w") == F.length("w")
    t = t.select("id", F.when(ascii_only, F.lower("w")).otherwise(F.translate("w", UPPER, LOWER)).alias("w"))
    if damage is not None:
        t = t.withColumn("h", F.crc32(F.concat_ws(":", "id", "w").cast("binary")))
        at = (F.col("h") % F.length("w")).cast("int")
        cut = F.concat(F.expr("substring(w, 1, cast(h % length(w) as int))"),
                       F.substring(F.col("w"), at + 2, F.length("w")))
        t = t.withColumn("w", F.when(F.col("h") % damage == 0, cut).otherwise(F.col("w")))
    return (t.where(F.length("w") >= min_length).groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


# --------------------------------------------------------------- composition

class Acceptor:
    """Minimised acyclic acceptor of sorted words: ``arcs[state]`` maps a code
    point to a state, ``final[state]`` tells whether a word ends there."""

    def __init__(self, sorted_words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}

        def number(final: bool, arcs: dict[str, int]) -> int:
            key = (final, tuple(arcs.items()))
            if key not in known:
                known[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return known[key]

        path: list[list] = [[False, {}]]          # states of the last word, not yet numbered
        last = ""
        for w in sorted_words:
            if w == last:
                continue
            k, top = 0, min(len(w), len(last))
            while k < top and w[k] == last[k]:
                k += 1
            for i in range(len(last), k, -1):
                state = path.pop()
                path[-1][1][last[i - 1]] = number(*state)
            path += [[False, {}] for _ in range(len(w) - k)]
            path[-1][0] = True
            last = w
        for i in range(len(last), 0, -1):
            state = path.pop()
            path[-1][1][last[i - 1]] = number(*state)
        self.start = number(*path.pop())


def composed(a: Acceptor, frm: int, prefix: str) -> Iterator[tuple[str, str]]:
    """Near pairs (longer or first, other) whose common part leads over ``frm``.

    Strings are kept as linked code points, so words of any length cost their
    length; states are numbered after all they lead to, so no call nests."""
    arcs, final = a.arcs, a.final
    common: dict[tuple[int, int], list] = {}

    def rest(p: int, q: int) -> list:
        """Strings that both states accept, as nested (code point, rest)."""
        todo = [(p, q) if p < q else (q, p)]
        while todo:
            x, y = key = todo[-1]
            if key in common:
                todo.pop()
                continue
            one, two = arcs[x], arcs[y]
            if len(one) > len(two):
                one, two = two, one
            both = [(c, (s, two[c]) if s < two[c] else (two[c], s)) for c, s in one.items() if c in two]
            missing = [k for _, k in both if k not in common]
            if missing:
                todo += missing
                continue
            out: list = [()] if final[x] and final[y] else []
            for c, k in both:
                out += [(c, r) for r in common[k]]
            common[key] = out
            todo.pop()
        return common[(p, q) if p < q else (q, p)]

    def spell(r: tuple) -> str:
        out = []
        while r:
            out.append(r[0])
            r = r[1]
        return "".join(out)

    stack: list[tuple] = [(frm, ())]
    while stack:
        q, before = stack.pop()
        out = list(arcs[q].items())
        head = None
        for i, (c, s) in enumerate(out):
            # deleted c: a rest that starts with c is listed at the next state
            hits = [(c, "", r) for r in rest(s, q) if not r or r[0] != c]
            hits += [(c, d, r) for d, t in out[i + 1:] for r in rest(s, t)]
            for x, y, r in hits:
                if head is None:
                    head = prefix + spell(before)[::-1]
                tail = spell(r)
                yield head + x + tail, head + y + tail
            stack.append((s, (c, before)))


# ------------------------------------------------------------------ partition

def _shared_length(a: str, b: str) -> F.Column:
    """Code points that two columns share at their start."""
    same = F.expr(f"transform(sequence(1, least(length({a}), length({b}))), "
                  f"i -> substring({a}, i, 1) = substring({b}, i, 1))")
    end = F.array_position(same, False)
    return F.when(end > 0, end - 1).otherwise(F.size(same)).cast("int")


def initial_states(forms: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Cut ``forms`` (w) by prefixes: (w, part) with parts of at most ``limit``
    words (or one word) and (w, part) once for each replaced state on its way.
    A level has at most words / limit replaced states; their list is broadcast.
    A replaced state is moved on to where its words part (what the first and the
    last of them share), so a level always parts words."""
    left = forms.withColumn("part", F.substring("w", 1, SHARED))
    whole, passed = [], []
    while True:
        sizes = left.groupBy("part").agg(F.count("*").alias("m"), F.min("w").alias("lo"), F.max("w").alias("hi"))
        large = written(sizes.where(F.col("m") > F.greatest(F.lit(limit), F.lit(1))).select(
            "part", _shared_length("lo", "hi").alias("k")), "large-states")
        if large.isEmpty():
            whole.append(left)
            break
        large = F.broadcast(large)
        whole.append(left.join(large.select("part"), "part", "left_anti"))
        inside = written(left.join(large, "part").select("w", F.expr("substring(w, 1, k)").alias("part"), "k"), "passed")
        passed.append(inside.select("w", "part"))
        # the word that ends where the others part is near some of them, never alone in need of a part
        left = inside.where(F.length("w") > F.col("k")).select("w", F.expr("substring(w, 1, k + 1)").alias("part"))
    out = whole[0]
    for w in whole[1:]:
        out = out.unionByName(w.select(*out.columns))
    if not passed:
        return out, left.limit(0)
    at = passed[0]
    for p in passed[1:]:
        at = at.unionByName(p)
    return out, at


def parting_at(passed: DataFrame) -> DataFrame:
    """Near pairs (a, b) that part right at a replaced state ``part``."""
    k = F.length("part")
    taken = F.expr("substring(w, length(part) + 2, length(w))")
    without = passed.where(F.length("w") > k).select("part", taken.alias("r"), F.col("w").alias("a"))
    as_is = passed.select("part", F.expr("substring(w, length(part) + 1, length(w))").alias("r"), F.col("w").alias("b"))
    replaced = without.join(without.withColumnRenamed("a", "b"), ["part", "r"]).where("a < b").select("a", "b")
    # deleting any of a run of equal code points gives one word: count its last one
    deleted = without.join(as_is, ["part", "r"]).where(
        F.expr("substring(a, length(part) + 1, 1)") != F.substring("r", 1, 1)).select("a", "b")
    return replaced.unionByName(deleted)


def pairs_within(forms: DataFrame, limit: int) -> DataFrame:
    """Near pairs (a, b) of ``forms`` (w) that share their first code points."""
    parts, passed = initial_states(forms, limit)
    src = parts.select("part", "w").repartition("part").sortWithinPartitions("part", "w")

    def run(batches):
        for t in sorted_runs(batches, ["part"], 20_000):
            w, part = t.column("w").to_pylist(), t.column("part").to_pylist()
            cuts = [*group_starts(t, ["part"]).tolist(), len(w)]
            found: tuple[list, list] = ([], [])
            for s, e in zip(cuts, cuts[1:]):
                n = len(part[s])
                acceptor = Acceptor([x[n:] for x in w[s:e]])
                for a, b in composed(acceptor, acceptor.start, part[s]):
                    found[0].append(a)
                    found[1].append(b)
                    if len(found[0]) >= 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in found], names=["a", "b"])
                        found = ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in found], names=["a", "b"])
    return src.mapInArrow(run, "a string, b string").unionByName(parting_at(passed))


def near_pairs(vocabulary: DataFrame, limit: int = 20_000) -> DataFrame:
    """Unordered near pairs (a, b) of ``vocabulary`` (word, distinct, five code
    points or more), each once."""
    forward = pairs_within(vocabulary.select(F.col("word").alias("w")), limit)
    back = pairs_within(vocabulary.select(F.reverse("word").alias("w")), limit)
    back = back.select(F.reverse("a").alias("a"), F.reverse("b").alias("b"))
    return forward.unionByName(back.where(F.substring("a", 1, SHARED) != F.substring("b", 1, SHARED)))


# --------------------------------------------------------------------- groups

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form): follow forms to the last one, by
    pointer doubling."""
    now = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = written(now.join(step, "root").select("word", F.col("further").alias("root"),
                                                    (F.col("further") != F.col("root")).alias("moved")), "roots")
        now = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return now


def variants(vocabulary: DataFrame, limit: int = 20_000, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n)."""
    vocab = written(vocabulary.select("word", "n"), "vocabulary")
    pairs = written(near_pairs(vocab, limit), "near-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(vocab.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = counted.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), F.col("b").alias("b"))).alias("best"))
    ok = -F.col("best.m") >= ratio * F.col("n")
    out = written(vocab.join(best, "word", "left").select(
        "word", F.when(ok, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(ok, -F.col("best.m")).alias("form_n")), "forms")
    return out.join(roots(out), "word").select("word", "form", "root", "n", "n_near", "form_n")
