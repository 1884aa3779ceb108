import random
import re
import zlib
from collections import Counter

import pytest

from corpusforge.llm import nearwords
from corpusforge.llm.queries import op11


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def counts(rows, least=3):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(x.lower() if x < "\x80" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= least}


def brute(vocab):
    out, form = {}, {}
    for w, n in vocab.items():
        found = [x for x in vocab if near(w, x)]
        best = min(found, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best and vocab[best] >= 2 * n else None
        out[w] = [form[w], n, len(found), vocab[best] if form[w] else None]
    for w in out:
        r = w
        while form[r]:
            r = form[r]
        out[w].insert(1, r)
    return {w: tuple(x) for w, x in out.items()}


def vocabulary(n, seed=1, letters="abcé", first=""):
    r = random.Random(seed)
    out = {}
    while len(out) < n:
        w = first + "".join(r.choices(letters, k=r.randrange(5, 8)))
        out[w] = r.choice([3, 3, 3, 6, 7, 12, 30, 60])
    return out


@pytest.mark.parametrize("limit", [1, 7, 20_000])
@pytest.mark.parametrize("first", ["", "zu"])
def test_variants_against_all_pairs(spark, limit, first):
    vocab = vocabulary(350, first=first) | {"aaaaa": 3, "aaaaaa": 3, "aaaaaaa": 9, "zuaaaa": 4, "zuaaaaa": 4}
    df = spark.createDataFrame([(n, w) for w, n in vocab.items()], "n long, word string")
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in nearwords.variants(df, limit).collect()}
    assert got == brute(vocab)


@pytest.mark.parametrize("limit", [1, 20_000])
def test_very_long_words(spark, limit):
    r = random.Random(8)
    long = "".join(r.choices("abc", k=5000))
    vocab = {long: 9, long[:2500] + long[2501:]: 4, "x" + long[1:]: 4, long[:-1] + "z": 3, "y" * 4000: 8, "y" * 4001: 4, "y" * 4003: 3}
    df = spark.createDataFrame([(w, n) for w, n in vocab.items()], "word string, n long")
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in nearwords.variants(df, limit).collect()}
    assert got == brute(vocab)


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(vocabulary(500, seed=3))
    a = nearwords.Acceptor(words)

    def walk(s, w):
        if a.final[s]:
            yield w
        for c, t in a.arcs[s].items():
            yield from walk(t, w + c)
    assert sorted(walk(a.start, "")) == words
    seen = {}
    for s in range(len(a.arcs)):
        language = frozenset(walk(s, ""))
        assert seen.setdefault(language, s) == s


def test_words_and_edge_rows(spark):
    r = random.Random(4)
    words = ["Hallo", "Größe", "größe", "GRÖSSE", "maison", "élève", "Élève", "a×b÷c", "word1word", "x"]
    rows = [(i, " ".join(r.choices(words, k=60)) + ",Straße-naïve_naïve") for i in range(40)]
    rows += [(None, "maison maison"), (3, None), (3, ""), (5, "größe " * 9), (5, "größe " * 9), (7, "漢字 12 !"), (8, "y" * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string")
    got = {x.word: x.n for x in nearwords.words(df).collect()}
    assert got == counts(rows) and "größe" in got and "grÖsse" in got
    plain = {x.word: x.n for x in nearwords.words(df, damage=None, min_count=1).collect()}
    assert plain["y" * 100_000] == 1
    assert nearwords.variants(nearwords.words(df.limit(0))).count() == 0
    both = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in nearwords.variants(nearwords.words(df)).collect()}
    assert both == brute(counts(rows))


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in op11(spark, d).collect()}
    assert got == brute(counts(rows))
