"""Conversation structure repair with a persistent audit DP.

The turns of a conversation must give role initials ``(s?(ua)+)?``.  A dynamic
program over the states start, after s, after u and after a finds the cheapest
edits: Keep (0), Rerole to user or assistant (2), Delete (3; the only edit of a
blank or duplicate turn), Insert of an empty user or assistant turn (2); a
truncated turn that stays adds 1.  The edits' initials in order are the audit;
of equally cheap audits the ASCII-least wins.

Audits of the four states share their prefixes as linked nodes.  Each node holds
its rolling hash and one jump pointer (binary lifting with one pointer per
node), so two equally cheap audits are compared by a search for their longest
common prefix in O(log n); the prefix is then verified node by node back to the
shared one, and a hash collision falls back to comparing the whole audits.

One shuffle by conversation, then sorts that spill: a window marks duplicates
and each conversation is streamed in order.  Held are four states, each with
the running digest of its repaired text, and the nodes of surviving audits (17
bytes an edit; what all states share is moved out and costs one byte).  No text
is held.  The SHA-256 of one text is sequential, so one task streams a whole
conversation, however long.

Defined cases: a null conv_id is a conversation of its own; null conv_id and
turn read as one space in the damage key, null role and text are one space;
turns go by number (null first), then role, then text, all before damage; rows
that repeat exactly are adjacent, so all but the first are duplicates; a role
without a first letter can only be reroled or deleted; gaps beyond 2^63 - 1 stay
there; other columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
MOD, BASE = (1 << 61) - 1, 1_000_003
FRESH, S, U, A = range(4)
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
#: (from state, to state, role) of the turns that may be put in
PUT = ((FRESH, U, "user"), (S, U, "user"), (A, U, "user"), (U, A, "assistant"))
STEPS = {"s": ((FRESH, S),), "u": ((FRESH, U), (S, U), (A, U)), "a": ((U, A),)}


class Audits:
    """Edit strings as linked nodes; node 0 is the empty audit."""

    def __init__(self, mod: int = MOD):
        self.mod = mod
        self.done = bytearray()
        self._clear()

    def _clear(self):
        self.parent, self.jump, self.depth = array("i", [0]), array("i", [0]), array("i", [0])
        self.hash, self.char = array("Q", [0]), bytearray(b" ")

    def add(self, p: int, char: int) -> int:
        j, d = self.jump, self.depth
        q = j[p]
        j.append(j[q] if d[p] - d[q] == d[q] - d[j[q]] and p else p)
        d.append(d[p] + 1)
        self.parent.append(p)
        self.hash.append((self.hash[p] * BASE + char) % self.mod)
        self.char.append(char)
        return len(d) - 1

    def up(self, v: int, depth: int) -> int:
        """Ancestor of ``v`` at ``depth``."""
        while self.depth[v] > depth:
            v = self.jump[v] if self.depth[self.jump[v]] >= depth else self.parent[v]
        return v

    def text(self, v: int, base: int = 0) -> bytes:
        out = bytearray()
        while v != base:
            out.append(self.char[v])
            v = self.parent[v]
        return bytes(out[::-1])

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` sorts before audit ``b``."""
        if a == b:
            return False
        h, jump, parent = self.hash, self.jump, self.parent
        n, m = self.depth[a], self.depth[b]
        x, y = self.up(a, min(n, m)), self.up(b, min(n, m))
        if h[x] == h[y]:
            return n < m if self._same(x, y) else self.text(a) < self.text(b)
        while True:                       # nodes of one depth have jumps of one depth
            if h[jump[x]] != h[jump[y]]:
                x, y = jump[x], jump[y]
            elif h[parent[x]] != h[parent[y]]:
                x, y = parent[x], parent[y]
            else:
                break
        if self._same(parent[x], parent[y]):
            return self.char[x] < self.char[y]
        return self.text(a) < self.text(b)

    def _same(self, x: int, y: int) -> bool:
        """Verify that two audits of one length and hash are equal."""
        while x != y:
            if self.char[x] != self.char[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def settle(self, live: list[int]) -> list[int]:
        """Move what all live audits share out and forget dead nodes; the new
        nodes of ``live``."""
        least = min(self.depth[v] for v in live)
        tops = {self.up(v, least) for v in live}
        while len(tops) > 1:
            least -= 1
            tops = {self.parent[v] for v in tops}
        top = tops.pop()
        self.done += self.text(top)
        paths = [self.text(v, top) for v in live]
        self._clear()
        out, known = [], {}
        for path in paths:
            v = 0
            for c in path:
                v = known.get((v, c)) or known.setdefault((v, c), self.add(v, c))
            out.append(v)
        return out


class Conversation:
    """Streams the turns of one conversation."""

    def __init__(self, settle_at: int = 200_000, mod: int = MOD):
        self.audits, self.settle_at = Audits(mod), settle_at
        # per state: (cost, audit, digest of the repaired text so far or None if it has no turn)
        self.best: list[tuple | None] = [(0, 0, None), None, None, None]
        self.rows = self.illegal = self.distinct = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = self.before = None

    def _better(self, cost: int, frm: tuple, char: int, role: str, text: str, old: tuple | None) -> tuple:
        """The better of ``old`` and ``frm`` followed by the edit ``char``."""
        if old is not None and old[0] < cost:
            return old
        node = self.audits.add(frm[1], char)
        if old is not None and old[0] == cost and not self.audits.less(node, old[1]):
            return old
        digest = frm[2]
        if char != ord("D"):
            digest = hashlib.sha256() if digest is None else digest.copy()
            digest.update(((role + ":" + text) if frm[2] is None else ("\n" + role + ":" + text)).encode())
        return cost, node, digest

    def _insert(self):
        b = self.best
        for frm, to, role in PUT:
            if b[frm] is not None:
                b[to] = self._better(b[frm][0] + 2, b[frm], ord("I"), role, "", b[to])

    def turn(self, number: int | None, role: str, text: str, fault: int):
        initial = role[:1]
        if number is not None:
            if self.first is None:
                self.first = number
            if number != self.last:
                self.distinct += 1
            self.last = number
        if self.rows:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.rows += 1
        self.before = initial
        self.faults[fault] += 1
        self._insert()
        old, new = self.best, [None] * 4
        for s in range(4):
            if old[s] is not None:
                new[s] = self._better(old[s][0] + 3, old[s], ord("D"), role, text, None)
        if fault not in (BLANK, DUPLICATE):
            more = 1 if fault == TRUNCATED else 0
            for frm, to in STEPS.get(initial, ()):
                if old[frm] is not None:
                    new[to] = self._better(old[frm][0] + more, old[frm], ord("K"), role, text, new[to])
            for frm, to, put in PUT:
                if old[frm] is not None:
                    new[to] = self._better(old[frm][0] + 2 + more, old[frm], ord("R"), put, text, new[to])
        # a state that another one can always follow for less is never part of a cheapest audit
        for s, by, cost in ((FRESH, A, 3), (FRESH, U, 5), (S, A, 0), (S, U, 2)):
            if new[s] is not None and new[by] is not None and new[s][0] > new[by][0] + cost:
                new[s] = None
        self.best = new
        if len(self.audits.depth) > self.settle_at:
            live = [b for b in new if b is not None]
            at = iter(self.audits.settle([b[1] for b in live]))
            self.best = [None if b is None else (b[0], next(at), b[2]) for b in new]
            # audits that stay apart are kept: wait until as much again is new
            self.settle_at = max(self.settle_at, 2 * len(self.audits.depth))

    def result(self) -> tuple:
        """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        self._insert()
        a, b = self.best[FRESH], self.best[A]
        if a is None or (b is not None and (b[0] < a[0] or (b[0] == a[0] and self.audits.less(b[1], a[1])))):
            a = b
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.distinct, 2 ** 63 - 1)
        digest = hashlib.sha256() if a[2] is None else a[2]
        return (gaps, *self.faults[1:], self.illegal, a[0],
                (bytes(self.audits.done) + self.audits.text(a[1])).decode(), digest.hexdigest())


def given(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, turn, role0, text0, copy, role, text, live) of undamaged turns."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    return turns.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        role.alias("role0"), text.alias("text0"), F.lit(0).alias("copy"),
                        role.alias("role"), text.alias("text"), F.lit(True).alias("live"))


def damaged(turns: DataFrame, **columns) -> DataFrame:
    """``given`` after the planted damage, by crc32('conv_id:turn') % 20: 0 drops
    the row (it stays as not live, to keep its conversation), 1 empties the text,
    2 removes its ``.!?``, 3 repeats the row, 4 sets role user."""
    t = given(turns, **columns)
    key = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    t = t.withColumn("hit", F.crc32(key.cast("binary")) % 20)
    t = t.withColumn("copy", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return t.select("conv", "turn", "role0", "text0", "copy",
                    F.when(F.col("hit") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"), (F.col("hit") != 0).alias("live"))


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), F.col("role0"), F.col("text0"), F.col("copy")]


def streamed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, fault, live): one shuffle by conversation, each
    in order inside its partition, with the first fault of every row."""
    end = F.rtrim("text", F.lit(WHITE))
    seen = F.row_number().over(Window.partitionBy("conv", "live", "role", "text").orderBy(*_order()))
    t = rows.repartition("conv").withColumn("seen", seen)
    fault = (F.when(F.length(end) == 0, BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(OK))
    return t.withColumn("fault", fault).sortWithinPartitions(F.col("conv").asc_nulls_first(), *_order())


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``given`` or ``damaged``: counts of faults,
    cost, audit and the digest of the repaired text."""
    src = streamed(rows).select("conv", "turn", F.when(F.col("live"), F.col("role")).alias("role"),
                                F.when(F.col("live"), F.col("text")).alias("text"), "fault")
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches):
        now, conv, out, size = None, None, [], 0
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                for c, turn, role, text, fault in zip(*(x.to_pylist() for x in part.columns)):
                    if now is None or c != conv:
                        if now is not None:
                            out.append((conv, *now.result()))
                            size += 200 + len(out[-1][7])
                            if size > 1_000_000:
                                yield batch(out)
                                out, size = [], 0
                        now, conv = Conversation(), c
                    if role is not None:
                        now.turn(turn, role, text, fault)
        if now is not None:
            out.append((conv, *now.result()))
            yield batch(out)
    return src.mapInArrow(run, RESULT)


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the turns that the audits of ``repair``
    leave or insert, streamed in order, with the edit that made each."""
    head = audits.select(F.col("conv_id").alias("conv"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role0"),
                         F.lit("").alias("text0"), F.lit(-1).alias("copy"), F.col("audit").alias("role"),
                         F.lit("").alias("text"), F.lit(0).alias("kind"))
    both = rows.where("live").drop("live").withColumn("kind", F.lit(1)).unionByName(head)
    src = both.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "kind", *_order()).select(
        "conv", "kind", "role", "text")

    def run(batches):
        edits, at, state, place, conv = "", 0, FRESH, 0, None

        def inserted():
            nonlocal at, state, place
            while at < len(edits) and edits[at] == "I":
                role, state = ("assistant", A) if state == U else ("user", U)
                yield conv, place, role, "", "I"
                at, place = at + 1, place + 1

        for b in batches:
            out = []
            for c, kind, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if kind == 0:
                    edits, at, state, place, conv = role, 0, FRESH, 0, c
                    out.extend(inserted())
                    continue
                edit = edits[at]
                at += 1
                if edit != "D":
                    if edit == "R":
                        role = "assistant" if state == U else "user"
                    state = {"s": S, "u": U, "a": A}[role[:1]]
                    out.append((c, place, role, text, edit))
                    place += 1
                out.extend(inserted())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5,
                                                (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                names=["conv_id", "place", "role", "text", "edit"])
    return src.mapInArrow(run, "conv_id long, place long, role string, text string, edit string")
