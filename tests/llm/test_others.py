import random
import re
import zlib

import numpy as np
import pytest

from corpusforge.llm import blocks, ordinal, packing, snapshots, tiling, triecount, vectors
from corpusforge.llm.queries import vocabulary

JSON, TIKTOKEN = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def texts(n, seed=1):
    r = random.Random(seed)
    alphabet = "ab é ßtheof12 \n\t\r\x0b\x0c\x1c\x1f\xa0 　'.!?-_\x00漢🙂"
    return ["".join(r.choices(alphabet, k=r.randrange(0, 80))) for _ in range(n)]


# ------------------------------------------------------------------ packing
def test_cached_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary(JSON))
    t = [*texts(3000), "it's we'll  x", "a  b\n\n c \n", "<|endoftext|> x <|endoftext|>", "   ", ""]
    enc = packing.CachedEncoder(vocabulary(JSON))
    for a, b in zip(enc(t), t):
        assert a.tolist() == tok.encode(b, add_special_tokens=False).ids, repr(b)


@pytest.mark.parametrize("rule,docs_cap,attn", [("norm", None, None), ("dot", 5, None), ("norm", 3, 900.0)])
def test_packing_holds_every_constraint(spark, rule, docs_cap, attn):
    from tokenizers import Tokenizer

    r = random.Random(2)
    rows = [(i, " ".join(r.choices(["one", "two", "three"], k=r.choice([1, 3, 9, 20, 29])))) for i in range(120)] + [(7, None), (7, ""), (None, "x")]
    df = spark.createDataFrame([(i, t, 1, "l") for i, t in rows], "doc_id long, text string, piece int, length string")
    cap = 40 if attn is None else 30
    got = packing.pack(df, vocabulary(JSON), capacity=cap, max_docs=docs_cap, max_attention=attn, rule=rule, rows_per_bucket=10).collect()
    tok = Tokenizer.from_file(vocabulary(JSON))
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        cut = len(ids) % cap or min(len(ids), cap)
        edges = [0, *range(cut, len(ids) + 1, cap)]
        want += [(i or -1, p, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())) for p, (s, e) in enumerate(zip(edges, edges[1:]))]
    assert sorted((x.doc_id or -1, x.piece, x.start, x.length, x.ids_crc32) for x in got) == sorted(want)
    bins = {}
    for x in got:
        bins.setdefault(x.sequence_id, []).append(x)
    for b in bins.values():
        at = 0
        for x in sorted(b, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= cap and len(b) <= (docs_cap or cap) and sum(x.length ** 2 for x in b) <= (attn or cap * cap)
    if docs_cap is None:                # as few as plain best-fit decreasing, but for one
        free = []
        for n in sorted((x.length for x in got), reverse=True):
            fit = [f for f in free if f >= n]
            if fit:
                free.remove(min(fit))
            free.append((min(fit) if fit else cap) - n)
        assert len(bins) <= len(free) + 1
    assert packing.pack(df.limit(0), vocabulary(JSON)).collect() == []


# ------------------------------------------------------------------ token counts
def test_trie_counts_against_plain_viterbi(spark):
    scores = triecount.load_scores(vocabulary(TIKTOKEN))

    def plain(w):
        best = [(0, 0)]
        for i in range(1, len(w) + 1):
            best.append(max((best[j][0] + scores[w[j:i]], best[j][1] - 1) for j in range(i) if w[j:i] in scores))
        return -best[-1][1]
    rows = [(i, t) for i, t in enumerate(texts(200, 3))] + [(None, None), (3, ""), (4, "antidisestablishmentarianism" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_pretokens, r.n_tokens) for r in triecount.token_counts(df, vocabulary(TIKTOKEN), stored=50).collect())
    want = []
    for i, t in rows:
        toks = triecount.PRETOKEN.findall((t or "").encode())
        assert b"".join(toks) == (t or "").encode()
        want.append((i if i is not None else -1, len(toks), sum(map(plain, toks))))
    assert got == sorted(want)


# ------------------------------------------------------------------ tiling
def test_tiles_are_longest_first_and_disjoint():
    p, t = list(range(20)), [*range(10, 20), 99, *range(0, 10), 98, 3, 4, 5, 6, 7]
    assert sorted(tiling.tile(p, t, 5)) == [(0, 11, 10), (10, 0, 10)]
    assert tiling.tile(p, [1, 2, 3], 5) == [] and tiling.tile([], t, 5) == []


def test_decontamination_catches_exact_and_reordered(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(1, "x y z " + item.upper() + "! end"), (2, "zeta eta theta iota kappa, then: alpha beta gamma delta epsilon"),
            (3, "alpha beta gamma delta epsilon only half"), (4, "clean text of other words"), (5, None), (None, item), (1, "x y z " + item)]
    df = spark.createDataFrame([(i, t, [1], "r") for i, t in rows], "doc_id long, text string, hits array<int>, row string")
    bench = spark.createDataFrame([(10, item), (11, "too short"), (None, None), (12, "w " * 400)], "item_id long, text string")
    for shard in (8_000_000, 50):
        got = tiling.decontaminate(df, bench, threshold=0.6, shard_bytes=shard).collect()
        bad = sorted((r.row.doc_id or -1) for r in got if r.hits)
        assert bad == [-1, 1, 1, 2] and len(got) == len(rows) and all(r.row.hits == [1] for r in got)
    assert tiling.decontaminate(df, bench.limit(0)).where("size(hits) > 0").count() == 0
    assert tiling.decontaminate(df.limit(0), bench).collect() == []


# ------------------------------------------------------------------ toxicity
def test_toxicity_on_held_out_rows(spark):
    r = random.Random(5)
    vocab = [f"word{i}" for i in range(300)]
    rows, lab = [], []
    for i in range(900):
        tox = r.random() < 0.2
        w = r.choices(vocab, k=r.randrange(5, 80)) + ([r.choice(["scum", "idiots", "vequfoo", "vequbar"]) for _ in range(r.randrange(2, 7))] if tox else [])
        r.shuffle(w)
        rows.append((i, " ".join(w), int(tox), "x"))
        if i < 500:
            lab.append((i, int(tox)))
    df = spark.createDataFrame([*rows, (None, None, 0, "x"), (1, "", 0, "x")], "doc_id long, text string, y int, toxic string").repartition(3)
    labels = spark.createDataFrame([*lab, (None, 1), (3, None), (10 ** 6, 1)], "doc_id long, toxic int")
    m = ordinal.train(df, labels)
    assert (np.diff(m.thresholds) > 0).all()
    got = ordinal.score(df, m).collect()
    assert len(got) == 902
    wrong = [x.row.doc_id for x in got if x.toxic != bool(x.row.y)]
    assert len(wrong) <= 9
    by = {}
    for x in got:
        n = len(re.findall(r"\b(?:scum|idiots|vequ\w+)", x.row.text or ""))
        by.setdefault(min(n, 6), []).append(x.expected_severity)
    means = [np.mean(by[k]) for k in sorted(by)]
    assert means == sorted(means)
    none = ordinal.train(df, labels.limit(0))
    assert not any(x.toxic for x in ordinal.score(df, none).collect())


# ------------------------------------------------------------------ chats
def test_snapshots_against_brute_force(spark):
    r = random.Random(6)
    convs, n = {}, 0
    for c in range(60):
        if convs and r.random() < 0.6:
            base = list(r.choice(list(convs.values())))
            base = base[:r.randrange(1, len(base) + 1)] if r.random() < 0.5 else base + [("user", f"more {r.randrange(5)}")] * (r.random() < 0.7)
        else:
            base = [(r.choice(["user", "system"]), "hi")] + [(r.choice(["user", "assistant"]), f"t{r.randrange(3)}") for _ in range(r.randrange(0, 5))]
        convs[c] = base
    rows = [(c, t, role, text, 5) for c, ts in convs.items() for t, (role, text) in enumerate(ts)]
    rows += [rows[0], rows[3], (None, None, None, None, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, n int").repartition(4)
    got = {x.conv_id: x for x in snapshots.maximal_chats(df).collect()}
    convs[None] = [("", "")]
    want = {}
    for c, ts in convs.items():
        same = [k for k, v in convs.items() if v == ts]
        longer = any(len(v) > len(ts) and v[:len(ts)] == ts for v in convs.values())
        if not longer and c == min(same, key=lambda k: -1 if k is None else k):
            want[c] = (len(ts), len(same), "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in ts))
    assert {c: (x.n_turns, x.n_copies, x.chat) for c, x in got.items()} == want
    assert snapshots.maximal_chats(df.limit(0)).collect() == []


# ------------------------------------------------------------------ vectors
@pytest.mark.parametrize("block", [1500, 40])
def test_vectors_against_brute_force(spark, block):
    g = np.random.default_rng(3)
    base = g.standard_normal((30, 16))
    x = [(base[i % 30] + g.standard_normal(16) * (0.05 if i % 3 else 0.4)).tolist() for i in range(300)]
    x += [x[0], x[0], [0.0] * 16, [float("nan")] * 16, None, [1.0, None], [], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 0.0]]
    rows = [(i * 2, v, 1) for i, v in enumerate(x)] + [(None, x[5], 1), (0, x[0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").repartition(3)
    rep = {}
    got = vectors.embedding_dedup(df, block=block, per_shard=60, sample=200, report=rep).collect()
    assert len(got) == len(rows) and rep["recall"] >= 0.98
    uniq = {(i if i is not None else -1, str(v)): (i if i is not None else -1, v) for i, v, _ in rows}
    vs = [(i, np.array(v)) for i, v in uniq.values() if v and None not in v and np.isfinite(v).all() and np.any(v)]
    up, n = list(range(len(vs))), [0] * len(vs)

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(vs)):
        for b in range(len(vs)):
            u, v = vs[a][1], vs[b][1]
            if a != b and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.9:
                n[a] += 1
                up[find(max(a, b))] = up[find(min(a, b))] = min(find(a), find(b))
    comp = {}
    for a in range(len(vs)):
        comp.setdefault(find(a), []).append(vs[a][0])
    want = {(vs[a][0], n[a], min(comp[find(a)])) for a in range(len(vs))} | {(i, 0, i) for i in (604, 606, 608, 610, 612)}
    assert {(r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id if r.component_id is not None else -1) for r in got} == want
    assert vectors.embedding_dedup(df.limit(0)).collect() == []


# ------------------------------------------------------------------ pages
def page(body):
    return ("<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=/x>Home</a></li></ul></nav>"
            f"<!-- c --><div class=\"ad\">Buy this now.</div><article>{body}</article><footer>&copy; site</footer></body>")


def test_leaves_and_extraction(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choices("aeioulrstn", k=r.randrange(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n)) + "."
    rows, want = [], {}
    for i in range(60):
        ps = [say(r.randrange(3, 40)) for _ in range(r.randrange(1, 9))]
        rows.append((i, f"u{i}", page("<h1>A &amp; B\n x</h1>" + "".join(f"<p><b>{p}<br>" if r.random() < 0.3 else f"<p>{p}</p>" for p in ps))))
        want[i] = "\n\n".join(["A & B x", *ps])
    rows += [(None, None, None), (100, "u", ""), (101, None, "<p"), (102, "u", "<!-- open"), (103, "u", "<script>x")]
    df = spark.createDataFrame([(i, u, h, "z") for i, u, h in rows], "page_id long, url string, html string, text string")
    got = {x.page_id: x for x in blocks.extract(df).collect()}
    assert len(got) == len(rows)
    assert sum(got[i].text == t for i, t in want.items()) >= 59
    assert got[None].text == "" and got[100].n_chars == 0 and got[102].text == "" and got[103].text == ""
    assert all(x.n_chars == len(x.text) for x in got.values())
    assert blocks.extract(df.limit(0)).collect() == []


def test_lstm_gradients_by_differences():
    g = np.random.default_rng(0)
    m = blocks.BiLSTM(hidden=3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    xs = [g.standard_normal((n, blocks.WIDTH)) for n in (4, 2)]
    x, mask, y = blocks.padded(xs, [g.integers(0, 2, len(v)).astype(float) for v in xs])
    _, grad = m.gradients(x.astype(np.float64), mask, y)
    for k in m.p:
        i = tuple(int(v) for v in g.integers(0, m.p[k].shape))
        keep = m.p[k][i]
        out = []
        for d in (1e-3, -1e-3):
            m.p[k][i] = keep + d
            out.append(m.gradients(x.astype(np.float64), mask, y)[0])
        m.p[k][i] = keep
        assert abs((out[0] - out[1]) / 2e-3 - grad[k][i]) < 2e-3, k
