import hashlib
import random
from collections import defaultdict

import pytest

from corpusforge.llm.repeats import text_tags
from corpusforge.llm.substring_dedup import SuffixAutomaton, substring_dedup
from corpusforge.llm.suffix_dedup import BlindTrie, suffix_dedup

SCHEMA = "doc_id long, text string, spans string, blob int, anchor int, start int"


def brute(rows, length, split):
    """rows: (doc_id, text) -> doc_id -> (n, removed mask, symbols)."""
    first = {}
    docs = [(i, split(t)) for i, t in rows]
    for i, s in sorted(docs, key=lambda r: r[0]):
        for p in range(len(s) - length + 1):
            key = tuple(s[p:p + length])
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = {}
    for i, s in docs:
        gone = [False] * len(s)
        for p in range(len(s) - length + 1):
            if first[tuple(s[p:p + length])] < (i, p):
                gone[p:p + length] = [True] * length
        out[i] = (gone, s)
    return out


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocab = [rnd.choice(["a", "b", "é", "über", "lorem", "x1", "the", "of"]) + str(rnd.randrange(40)) for _ in range(80)]
    passages = [" ".join(rnd.choices(vocab, k=rnd.randrange(10, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rnd.random()
        t = " ".join(rnd.choices(vocab, k=rnd.randrange(0, 80)))
        if kind < 0.5:
            t += " " + rnd.choice(passages) + rnd.choice([" ", "\n\t"]) + " ".join(rnd.choices(vocab, k=rnd.randrange(0, 30)))
        elif kind < 0.6 and rows:
            t = rnd.choice(rows)[1]
        elif kind < 0.65:
            t = "z " * rnd.randrange(0, 150) + "aaaaaaaa" * rnd.randrange(0, 60)
        rows.append((i * 3 - 20, t))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2, 3) for i, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("block,hot", [(2, 1_000_000), (1024, 1_000_000), (1024, 2), (2, 1)])
def test_words_against_brute_force(spark, block, hot):
    rows = corpus(1)
    want = brute(rows, 7, lambda t: t.split())
    got = substring_dedup(frame(spark, rows), length=7, k=3, block=block, rows_per_shard=16, hot_rows=hot).collect()
    assert len(got) == len(rows)
    for r in got:
        gone, words = want[r.doc_id]
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert (r.n_words, r.n_removed, r.kept_text) == (len(words), sum(gone), kept)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("block,hot", [(2, 1_000_000), (2048, 1_000_000), (2048, 2)])
def test_bytes_against_brute_force(spark, block, hot):
    rows = corpus(2)
    want = brute(rows, 40, lambda t: list(t.encode()))
    got = suffix_dedup(frame(spark, rows), length=40, k=12, block=block, rows_per_shard=64, hot_rows=hot).collect()
    assert len(got) == len(rows)
    for r in got:
        gone, data = want[r.doc_id]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(data), sum(gone), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_edge_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, long), (4, "x " * 30), (4, "x " * 30), (5, "x " * 30)]
    df = frame(spark, rows)
    w = substring_dedup(df, length=20, with_text=False).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in w) == sorted((i or -1, len((t or "").split())) for i, t in rows)
    by = defaultdict(list)
    for r in w:
        by[r.doc_id].append(r.n_removed)
    assert by[3] == [60_000 - 977] and by[4] == [29, 29] and by[5] == [30]
    b = suffix_dedup(df, length=100).collect()
    assert sorted((r.doc_id or -1, r.n_bytes) for r in b) == sorted((i or -1, len((t or "").encode())) for i, t in rows)
    empty = frame(spark, [])
    assert substring_dedup(empty).collect() == [] and suffix_dedup(empty, with_text=True).collect() == []


def test_kept_text_stays_valid(spark):
    p = "é" * 60
    got = {r.doc_id: r for r in suffix_dedup(frame(spark, [(1, "q" + p), (2, "w" + p + "ü")]), with_text=True).collect()}
    assert got[1].n_removed == 118 and got[1].kept_text == "qé"
    assert got[2].n_removed == 121 and got[2].kept_text == "wü"


def test_automaton_matching_statistics():
    rnd = random.Random(3)
    for _ in range(30):
        words = [[rnd.randrange(3) for _ in range(rnd.randrange(1, 12))] for _ in range(4)]
        sam = SuffixAutomaton()
        for w in words:
            sam.add(w)
        subs = {tuple(w[i:j]) for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        q = [rnd.randrange(4) for _ in range(20)]
        want = [max([n for n in range(1, i + 2) if tuple(q[i + 1 - n:i + 1]) in subs], default=0) for i in range(20)]
        assert sam.matching(q) == want


def test_blind_trie_sorts():
    rnd = random.Random(4)
    for _ in range(50):
        items = [bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(40)]
        trie, first = BlindTrie(), {}
        for i, s in enumerate(items):
            assert trie.insert(s, i) == first.get(s)
            first.setdefault(s, i)
        assert [s for s, _ in trie] == sorted(set(items))


def test_hot_anchor_is_salted(spark):
    """A passage in every document, other words around it: its anchors' rows
    take several salts and the result stays exact."""
    from corpusforge.llm import repeats

    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, f"a{i} b{i * 7} c{i} {shared} d{i} e{i * 3} f{i}") for i in range(300)]
    df = frame(spark, rows)
    src = df.select("doc_id", "text").repartition(300)       # no folding inside a batch
    salts = repeats._salts(src.mapInArrow(repeats._segments_of(repeats.word_symbols, 10, 4), "g long, n long"), 50)
    assert salts.max() >= 6
    got = {r.doc_id: r.n_removed for r in substring_dedup(src, length=10, k=4, hot_rows=50, block=16).collect()}
    assert got == {i: 40 if i else 0 for i, _ in rows}


@pytest.mark.parametrize("hot", [1_000_000, 2])
def test_copies_of_a_row_keep_their_own_text(spark, hot):
    """Rows that repeat exactly (also under a null id) and share a passage with
    other documents, with other text around it."""
    shared = " ".join(f"s{i}" for i in range(30))
    once = [(i, " ".join(f"u{i}x{j}" for j in range(25)) + f" {shared} " + " ".join(f"v{i}x{j}" for j in range(25)))
            for i in [None, *range(1, 12)]]
    rows = [r for i, r in enumerate(once) for _ in range(3 if i % 2 == 0 else 1)]
    key = [(-1 if i is None else i, t) for i, t in once]
    df = frame(spark, rows).repartition(len(rows))             # copies in tasks of their own
    want = {i: sum(gone) for i, (gone, _) in brute(key, 10, lambda t: t.split()).items()}
    got = substring_dedup(df, length=10, k=4, hot_rows=hot).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed) for r in got) == \
        sorted((-1 if i is None else i, want[-1 if i is None else i]) for i, _ in rows)
    want = {i: sum(gone) for i, (gone, _) in brute(key, 40, lambda t: list(t.encode())).items()}
    got = suffix_dedup(df, length=40, k=12, hot_rows=hot).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_removed) for r in got) == \
        sorted((-1 if i is None else i, want[-1 if i is None else i]) for i, _ in rows)


@pytest.mark.parametrize("doc_id", [None, 4])
def test_texts_of_one_id_and_equal_crc32_stay_apart(spark, doc_id):
    """Two texts of one id whose crc32 are equal, one of them holding a passage twice."""
    import zlib

    passage = " ".join(f"p{j}" for j in range(30))
    head = " ".join(f"a{j}" for j in range(200)) + f" {passage} mid {passage}"
    rnd, seen, texts = random.Random(1), {}, None
    while texts is None:                        # a birthday search over both texts' ends
        x, y = "".join(rnd.choices("abcdefghij", k=9)), "".join(rnd.choices("klmnopqrst", k=9))
        seen[zlib.crc32(f"{head} {x}".encode())] = x
        z = zlib.crc32(f"{passage} short {y}".encode())
        if z in seen:
            texts = f"{head} {seen[z]}", f"{passage} short {y}"
    assert zlib.crc32(texts[0].encode()) == zlib.crc32(texts[1].encode())
    tags = dict(zip(texts, zip(*(x.tolist() for x in text_tags([t.encode() for t in texts])))))
    df = frame(spark, [(doc_id, texts[0]), (doc_id, texts[1]), (doc_id, texts[1]), (9, passage)])
    for got, size, sym in ((substring_dedup(df, length=10, k=4), 10, lambda t: t.split()),
                           (suffix_dedup(df, length=40, k=12), 40, lambda t: list(t.encode()))):
        first, want = {}, {}
        docs = [(-1 if doc_id is None else doc_id, tags[t], sym(t), t) for t in texts] + [(9, (0, 0), sym(passage), passage)]
        for i, tag, s, t in docs:               # smaller id, then earlier start, then the text's hash
            for p in range(len(s) - size + 1):
                key = tuple(s[p:p + size])
                first[key] = min(first.get(key, (i, p, tag)), (i, p, tag))
        for i, tag, s, t in docs:
            gone = set()
            for p in range(len(s) - size + 1):
                if first[tuple(s[p:p + size])] != (i, p, tag):
                    gone |= set(range(p, p + size))
            want[t] = len(gone)
        rows = [want[texts[0]], want[texts[1]], want[texts[1]], want[passage]]
        assert sorted(r.n_removed for r in got.collect()) == sorted(rows)
