import hashlib
import itertools
import random
import re
import zlib

import pytest

from corpusforge.llm import audit
from corpusforge.llm.queries import op13

GOOD = re.compile(r"(s?(ua)+)?\Z")
WS = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            new = (conv, turn, role, "")
        elif k == 2:
            new = (conv, turn, role, re.sub("[.!?]", "", text))
        elif k == 4:
            new = (conv, turn, "user", text)
        else:
            new = (conv, turn, role, text)
        out += [((turn is not None, turn or 0, role, text), new)] * (0 if k == 0 else 2 if k == 3 else 1)
    return [x for _, x in sorted(out, key=lambda x: x[0])]


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        found = WS.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """All edit sequences with up to two inserts in a gap."""
    fs, best = faults(rows), None
    choice = []
    for (_, _, role, text), f in zip(rows, fs):
        c = [("D", 3, None)]
        if f not in ("blank", "duplicate"):
            more = 1 if f == "truncated" else 0
            c += [("K", more, (role, text))] + [("R", 2 + more, (r, text)) for r in ("user", "assistant")]
        choice.append(c)
    gap = [[("I" * n, 2 * n, t) for n in range(3) for t in itertools.product([("user", ""), ("assistant", "")], repeat=n)]] * (len(rows) + 1)
    for edits in itertools.product(*choice):
        for ins in itertools.product(*gap):
            turns, cost, s = list(ins[0][2]), ins[0][1], ins[0][0]
            for e, g in zip(edits, ins[1:]):
                s, cost = s + e[0] + g[0], cost + e[1] + g[1]
                turns += ([e[2]] if e[2] else []) + list(g[2])
            if (best is None or (cost, s) < best[:2]) and GOOD.match("".join(r[:1] or "?" for r, _ in turns)):
                best = (cost, s, turns)
    turns_, init = {t for _, t, _, _ in rows if t is not None}, [r[:1] for _, _, r, _ in rows]
    gaps = max(turns_) - min(turns_) + 1 - len(turns_) if turns_ else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(init, init[1:]))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in best[2]).encode()).hexdigest()
    return (gaps, fs.count("blank"), fs.count("duplicate"), fs.count("truncated"), illegal, best[0], best[1], sha), best[2]


def by_strings(rows):
    """The same program with whole audits as strings, for long conversations."""
    fs = faults(rows)
    best = {"": (0, "", ())}
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    def keep(new, s, v):
        if s not in new or v < new[s]:
            new[s] = v

    def put(best):
        for _ in range(2):
            for s in list(best):
                c, a, t = best[s]
                nxt = step[s][-1]
                keep(best, nxt, (c + 2, a + "I", t + (({"u": "user", "a": "assistant"}[nxt], ""),)))
    for (_, _, role, text), f in zip(rows, fs):
        put(best)
        new = {}
        for s, (c, a, t) in best.items():
            keep(new, s, (c + 3, a + "D", t))
            if f not in ("blank", "duplicate"):
                more = f == "truncated"
                if role[:1] and role[:1] in step[s]:
                    keep(new, role[:1], (c + more, a + "K", t + ((role, text),)))
                nxt = step[s][-1]
                keep(new, nxt, (c + 2 + more, a + "R", t + (({"u": "user", "a": "assistant"}[nxt], text),)))
        best = new
    put(best)
    c, a, t = min(best[s] for s in ("", "a") if s in best)
    return c, a, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in t).encode()).hexdigest()


def conversation(r, conv, n):
    return [(conv, t, r.choice(["user", "assistant", "system", "user", "assistant", "tool", "unk"]),
             r.choice(["Hi.", "Well", "No!", " \t", "Hi."])) for t in range(n)]


def run(rows, **kw):
    c = audit.Conversation(**kw)
    for (_, t, role, text), f in zip(rows, faults(rows)):
        c.turn(t, role, text, ["", "blank", "duplicate", "truncated"].index(f))
    return c.result()


def test_small_conversations_against_all_edits():
    r = random.Random(5)
    for k in range(150):
        rows = conversation(r, k, r.choice([1, 2, 3, 3]))
        assert run(rows) == brute(rows)[0], rows


@pytest.mark.parametrize("settle_at,mod", [(200_000, audit.MOD), (20, audit.MOD), (200_000, 7), (30, 5)])
def test_long_conversations_ties_and_collisions(settle_at, mod):
    r = random.Random(6)
    for k in range(60):
        n = r.choice([5, 20, 60])
        rows = [(k, t, r.choice(["user"] * 3 + ["assistant", "system"]), f"{r.randrange(n)}{r.choice('.! x')}") for t in range(n)]
        assert run(rows, settle_at=settle_at, mod=mod)[5:] == by_strings(rows), rows


def test_a_very_long_conversation_holds_little():
    c = audit.Conversation(settle_at=2_000)
    for t in range(30_000):
        c.turn(t, "user" if t % 2 == 0 or t % 1000 == 1 else "assistant", f"{t}.", audit.OK)
    assert len(c.audits.depth) < 5_000
    assert len(c.result()[6]) >= 30_000


def test_table_and_edge_rows(spark):
    r = random.Random(7)
    rows = [x for k in range(120) for x in conversation(r, k, r.choice([1, 2, 3]))]
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", None), (900, None, None, "x."), (900, 4, "", "y."),
             (901, 3, "user", "a."), (901, 3, "user", "a."), (902, -5, "user", "a?"), (902, 7, "assistant", "b\x0b")]
    df = spark.createDataFrame([(*x, 1, "q") for x in rows],
                               "conv_id long, turn long, role string, text string, fault int, audit string")
    d = audit.damaged(df)
    out = audit.repair(d)
    got = {x.conv_id: tuple(x)[1:] for x in out.collect()}
    assert set(got) == {x[0] for x in rows}
    turns = {}
    for x in audit.repaired_turns(d, out).collect():
        turns.setdefault(x.conv_id, []).append((x.place, x.role, x.text))
    for conv in got:
        mine = damage([x for x in rows if x[0] == conv])
        want, repaired = brute(mine)
        assert got[conv] == want, (conv, mine)
        assert [x[1:] for x in sorted(turns.get(conv, []))] == repaired
    assert audit.repair(audit.damaged(df.limit(0))).count() == 0
    whole = audit.repair(audit.given(df)).where("conv_id = 901").first()
    assert (whole.duplicate, whole.audit) == (1, "KDI")     # ASCII-least of equal cost


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = {}
    for x in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        rows.setdefault(x.conv_id, []).append(tuple(x))
    got = {x.conv_id: x for x in op13(spark, d).collect()}
    assert set(got) == set(rows)
    for conv, mine in rows.items():
        x = got[conv]
        assert (x.cost, x.audit, x.repaired_sha256) == by_strings(damage(mine))
