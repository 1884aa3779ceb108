import collections
import random

import pytest

from corpusforge.functions.bytelevel import to_symbols
from corpusforge.operators import bpe


def greedy(words, n_merges, min_freq=2):
    state = {tuple(w): f for w, f in words.items()}
    merges = []
    while len(merges) < n_merges:
        c = collections.Counter()
        for s, f in state.items():
            for a, b in zip(s, s[1:]):
                c[(a, b)] += f
        cands = [(-n, a, b) for (a, b), n in c.items() if n >= min_freq]
        if not cands:
            break
        _, a, b = min(cands)
        merges.append((a, b))
        new = collections.Counter()
        for s, f in state.items():
            out, i = [], 0
            while i < len(s):
                if i < len(s) - 1 and s[i] == a and s[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            new[tuple(out)] += f
        state = new
    return merges


def word_table(spark, counts):
    rows = [(w, f, list(to_symbols(w))) for w, f in counts.items()]
    return spark.createDataFrame(rows, "word string, freq long, syms array<string>")


@pytest.mark.parametrize("seed,alphabet", [(0, "aab"), (1, "aab"), (2, "aab"), (3, "aab"), (4, "abc"),
                                           (5, "abcd"), (6, "aabc")])
def test_exact_batches_equal_greedy(spark, seed, alphabet):
    rnd = random.Random(seed)
    counts = {}
    for _ in range(60):
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7)))
        counts[w] = counts.get(w, 0) + rnd.randint(1, 9)
    counts.update({"aaaa": 7, "abab": 5})
    model = bpe.train_bpe(word_table(spark, counts), vocab_size=6 + 256 + 25, min_frequency=2,
                          checkpoint_every=3)
    assert model.merges == greedy({to_symbols(w): f for w, f in counts.items()}, 25)


@pytest.mark.parametrize("seed,alphabet,tracked", [(11, "abc", 5), (13, "abcdefghij", 1000), (15, "aé漢z", 12)])
def test_long_training_equals_greedy(spark, seed, alphabet, tracked):
    """Many ties, symbols made twice, thresholds that fall while training."""
    rnd = random.Random(seed)
    counts = {}
    for _ in range(250):
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12)))
        counts[w] = counts.get(w, 0) + rnd.choice([1, 1, 2, 3])
    model = bpe.train_bpe(word_table(spark, counts).repartition(3), vocab_size=6 + 256 + 60, min_frequency=2,
                          checkpoint_every=5, tracked_pairs=tracked)
    want = greedy({to_symbols(w): f for w, f in counts.items()}, 60)
    assert model.merges == want and model.rounds <= len(want)


def test_batches_of_tied_pairs_equal_greedy():
    """The driver's choice of batches alone, against one merge at a time."""
    import numpy as np

    from corpusforge.operators import bpetrain

    for seed in range(120):
        rnd = random.Random(seed)
        letters = "abcdefgh"[:rnd.choice([2, 3, 5, 8])]
        counts = {"".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))): rnd.choice([1, 1, 1, 2]) for _ in range(40)}
        names = sorted(letters)
        known = {s: i for i, s in enumerate(names)}
        block = (np.array([known[c] for w in counts for c in w], np.int32), np.array([len(w) for w in counts]),
                 np.array(list(counts.values())))
        t, got, most = bpetrain.Tracked(names), [], 0

        def recount():
            k, c = bpetrain.summed(*bpetrain.weighted_pairs(*block))
            t.reset(zip((k >> 32).tolist(), (k & 0xFFFFFFFF).tolist(), c.tolist()), 1)
        recount()
        while batch := t.batch(known, 64):
            most = max(most, len(batch))
            again = False
            coded = {}
            for l, r in batch:
                s = names[l] + names[r]
                again |= s in known
                if s not in known:
                    known[s] = len(names)
                    names.append(s)
                coded[l << 32 | r] = known[s]
                got.append((names[l], names[r]))
            keys = np.array(sorted(coded))
            done = bpetrain.merge_block(*block, keys, np.array([coded[k] for k in keys.tolist()], np.int32))
            block = done[:3]
            if again:
                recount()
            else:
                k, c = done[3]
                t.add(zip((k >> 32).tolist(), (k & 0xFFFFFFFF).tolist(), c.tolist()))
        assert got == greedy(counts, 10_000, 1), seed


def test_all_counts_below_minimum(spark):
    model = bpe.train_bpe(word_table(spark, {"ab": 1, "cd": 1}), vocab_size=6 + 256 + 10, min_frequency=2)
    assert model.merges == []


def test_fast_mode_runs_fewer_rounds(spark):
    rnd = random.Random(9)
    counts = {"".join(rnd.choice("abcdefgh") for _ in range(6)): rnd.randint(1, 20) for _ in range(300)}
    exact = bpe.train_bpe(word_table(spark, counts), 6 + 256 + 40)
    fast = bpe.train_bpe(word_table(spark, counts), 6 + 256 + 40, mode="fast", fast_k=16)
    assert len(fast.merges) == len(exact.merges) == 40 and fast.rounds <= exact.rounds


def test_long_words_segment_alike_and_fast():
    import time

    from corpusforge.functions import bytelevel

    rnd = random.Random(5)
    for _ in range(300):
        letters = "abcd"[:rnd.choice([1, 2, 3, 4])]
        symbols, pairs = list(letters), []
        for _ in range(25):                       # ranks in any order, symbols made in several ways
            p = (rnd.choice(symbols), rnd.choice(symbols))
            pairs.append(p)
            symbols.append(p[0] + p[1])
        pairs = list(dict.fromkeys(pairs))
        rnd.shuffle(pairs)
        ranks = {p: i for i, p in enumerate(pairs)}
        word = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, bytelevel.LONG_WORD)))
        assert bytelevel.segment_long(word, ranks) == bytelevel.bpe_segment(word, ranks)
    ranks = {("a", "b"): 0, ("b", "a"): 1, ("ab", "ab"): 2, ("a", "ab"): 3, ("abab", "abab"): 4}
    word = "".join(rnd.choice("ab") for _ in range(1_000_000))
    t = time.perf_counter()
    assert "".join(bytelevel.bpe_segment(word, ranks)) == word
    assert time.perf_counter() - t < 30


def test_encode_decode_roundtrip_and_specials(spark):
    texts = ["Hello  world, héllo wörld!\n\tTabs  and   spaces ", "ünïcödé 123 <|eos|> end", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    words = bpe.pretoken_counts(df, "text")
    model = bpe.train_bpe(words, 6 + 256 + 20, min_frequency=1)
    enc, dec = bpe.encode_column(spark, model), bpe.decode_column(spark, model)
    got = df.select("i", "text", enc("text").alias("ids")).withColumn("back", dec("ids")).orderBy("i").collect()
    assert got[0].back == texts[0] and got[2].back == "" and list(got[2].ids) == []
    assert model.token_to_id["<|eos|>"] in got[1].ids  # reference behaviour: specials in text match
    esc = bpe.encode_column(spark, model, specials_mode="escape")
    e = df.select(esc("text").alias("ids")).orderBy("i").collect()[1]
    assert model.token_to_id["<|eos|>"] not in e.ids
    # pretokenisation is lossless
    assert all(r.ok for r in df.select((F_join("text")).alias("ok")).collect())
    v, m = model.vocab_df(spark), model.merges_df(spark)
    again = bpe.BpeModel.from_frames(v, m)
    assert again.token_to_id == model.token_to_id and again.merges == model.merges


def F_join(col):
    from pyspark.sql import functions as F
    return F.array_join(bpe.pretokens(col), "") == F.col(col)


def test_bpe_corpus_plan_equals_flat_brute_force(spark):
    import regex

    from corpusforge.functions.bytelevel import bpe_segment
    from corpusforge.plans import corpus
    from conftest import docs as load_docs

    p = corpus.CorpusParams(context_length=64)
    d = load_docs(spark)
    model = corpus.train_bpe_model(d, p, merges=20)
    toks = corpus.tokenize_documents_bpe(corpus.split_documents(d, p), model, p)
    seqs = corpus.packed(corpus.streamed_documents(toks), p).collect()
    pat = regex.compile(r"<\|(?:pad|unk|bos|eos|user|assistant)\|>|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                        r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    ranks = model.ranks()
    rows = corpus.split_documents(d, p).select("doc_id", "text", "split", "pos").collect()
    streams = {"train": [], "validation": []}
    for r in sorted(rows, key=lambda r: r.pos):
        ids = [model.token_to_id[t] for w in pat.findall(r.text) for t in bpe_segment(to_symbols(w), ranks)]
        streams[r.split] += [2] + ids + [3]
    got = {(r.split, r.seq_id): list(r.input_ids) + [r.target_ids[-1]] for r in seqs}
    for split, flat in streams.items():
        n = max(0, (len(flat) - 65) // 64 + 1)
        assert [got[(split, i)] for i in range(n)] == [flat[i * 64:i * 64 + 65] for i in range(n)]
        assert len([k for k in got if k[0] == split]) == n


def test_pretoken_count_formula_matches_lookahead_pattern(spark):
    """The DuckDB oracle for T1 counts look-ahead-free matches plus a
    correction; check both against the JVM pattern on whitespace edge rows."""
    import duckdb
    import regex

    import corpusforge.plans.queries_tok  # noqa: F401 (registers t1)
    from corpusforge.plans.queries import ORACLES

    texts = ["a  b", "a\n\nb", "a \nb", "a\n b", "  x", "x  ", "x\t\t\ty", "p  q", "it's  'quoted'  ",
             "1 2  3\n\n\n4", "   ", "\n", "a　　b", "end.\n\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    spark_n = {r.doc_id: r.n for r in df.select("doc_id", F_size(bpe.pretokens("text")).alias("n")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id INTEGER, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    duck_n = {r[0]: r[1] for r in con.execute(ORACLES["t1_pretokenize"]).fetchall()}
    pat = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    py_n = {i: len(pat.findall(t)) for i, t in enumerate(texts)}
    assert spark_n == duck_n == py_n


def F_size(c):
    from pyspark.sql import functions as F
    return F.size(c)


def test_rounds_work_on_distinct_segments(spark):
    """Words cut at rare pairs: the counts of the pairs kept stay, equal segments are one."""
    import numpy as np

    from corpusforge.operators import bpetrain

    counts = {"abab" + a + b + "baba": 1 for a in "cdefgh" for b in "cdefgh"} | {"x": 3, "ab": 4}
    code = {c: i for i, c in enumerate(sorted(bpe.BYTE_CHARS))}
    blocks = bpetrain.blocks_of(word_table(spark, counts).repartition(2), code)
    key = bpetrain._key(np.array([code["a"], code["b"]]), np.array([code["b"], code["a"]]))
    full = {(r["l"], r["r"]): r["c"] for r in bpetrain.pair_table(blocks).collect()}
    found = bpetrain.segments(blocks, np.sort(key))
    kept = {(r["l"], r["r"]): r["c"] for r in bpetrain.pair_table(found).collect()}
    assert kept == {p: c for p, c in full.items() if set(p) == {code["a"], code["b"]}}
    assert sum(len(r["freqs"]) // 8 for r in found.collect()) == 3        # abab, baba, ab


def test_symbols_of_all_bytes(spark):
    words = ["a", "\x00\x7f é", "漢🙂", "\xa0\xad"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select(bpe.to_symbol_array("word")).collect()
    assert [list(r[0]) for r in got] == [list(to_symbols(w)) for w in words]


def test_encoder_works_in_slices_and_bounds_its_cache(monkeypatch):
    import pyarrow as pa

    rows = [[f"w{i}", "ab"] for i in range(50)] + [None, []]
    t2i = {c: i for i, c in enumerate(bpe.BYTE_CHARS)}
    want = bpe._encode_lists(pa.array(rows), t2i, {}, {}, {}).to_pylist()
    sizes, whole = [], bpe._encode_rows

    def watched(toks, *rest):
        sizes.append(len(toks))
        return whole(toks, *rest)
    monkeypatch.setattr(bpe, "_SLICE", 10)
    monkeypatch.setattr(bpe, "_CACHE_LIMIT", 20)
    monkeypatch.setattr(bpe, "_encode_rows", watched)
    cache = {}
    assert bpe._encode_lists(pa.array(rows), t2i, {}, {}, cache).to_pylist() == want
    assert max(sizes[:-1]) == 5 and len(cache) <= 30


def odd_texts(n, seed=5):
    rnd = random.Random(seed)
    parts = [*"abSTs'’ \n\t\r!.1٣Ⅷ漢é́ \u0085　​🙂𝟘𐐀", "'s", "'re", "'ll", "'ve", "'d", "'m", "'t", "  ", " '", "''", "'rex", "'l",
             "<|eos|>", "<|user|>", " <|eos", "|>"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(n)] + ["", " ", "'", "a" * 90, "'s" * 40, None]


@pytest.mark.parametrize("cut_bytes", [64, 1 << 20])
def test_batches_are_cut_as_the_pattern_cuts(spark, cut_bytes, monkeypatch):
    import pyarrow as pa

    from corpusforge.functions import cutting
    from corpusforge.functions.text import CHAT_SPECIALS

    monkeypatch.setattr(cutting, "CUT_BYTES", cut_bytes)
    texts = odd_texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = df.select("i", bpe.pretokens("text").alias("p"), bpe.pretokens("text", CHAT_SPECIALS).alias("s")).orderBy("i").collect()
    classes = cutting.char_classes(spark)
    for specials, col in (((), "p"), (CHAT_SPECIALS, "s")):
        array = pa.array(["skipped", *texts]).slice(1)
        got = [row for part in cutting.cut_texts(array, classes, specials) for row in part.to_pylist()]
        assert got == [None if r[col] is None else [t for t in r[col] if t] for r in want]


def test_classes_are_the_jvm_regex_ones(spark):
    import zlib

    from corpusforge.functions import cutting

    table = zlib.decompress(cutting.char_classes(spark))
    assert len(table) == 0x110000
    assert bytes(table[ord(c)] for c in "aé漢𐐀7٣Ⅷ \u0085　​'🙂") == b"aaaa000   !!!"


def test_words_are_counted_before_spark_sees_them(spark):
    texts = odd_texts(400) + ["the the of"] * 30
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = bpe.pretoken_counts(df)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "regexp_extract_all" not in plan
    want = collections.Counter(w for r in df.select(bpe.pretokens("text").alias("p")).collect() for w in r.p or [])
    assert {r["word"]: r["freq"] for r in counts.collect()} == want


@pytest.mark.parametrize("alphabet", ["ab", "abc", "aé漢"])
def test_words_segmented_together_equal_one_at_a_time(alphabet):
    from corpusforge.functions.bytelevel import MergeTable, bpe_segment

    rnd = random.Random(len(alphabet))
    words = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)})
    merges = greedy({to_symbols(w): 1 for w in words}, 30)
    # also ranks that training would not give: a merged string made twice, a lower rank after a higher one
    for order in (merges, rnd.sample(merges, len(merges))):
        ranks = {m: i for i, m in enumerate(order)}
        table = MergeTable(ranks)
        syms, size = table.segment([w.encode() for w in words])
        names, at, got = [table.names[s] for s in syms], 0, []
        for n in size:
            got.append(names[at:at + n])
            at += n
        assert got == [bpe_segment(to_symbols(w), ranks) for w in words]
    assert MergeTable({}).segment([b"ab", b""])[1].tolist() == [2, 0]


def test_ids_are_counted_and_decoded_some_texts_at_a_time(spark, monkeypatch):
    from corpusforge.functions import cutting

    model = bpe.BpeModel(["<|eos|>"], sorted(bpe.BYTE_CHARS), greedy({"abab": 3, "Ġab": 2, "ĠĠ": 2}, 4))
    texts = odd_texts(300) + ["ab" * 60 + "<|eos|>", " abab"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    monkeypatch.setattr(bpe, "_DECODED", 7)
    enc, n = bpe.encode_column(spark, model), bpe.token_count_column(spark, model)
    decoded = bpe.decode_column(spark, model, skip_special=False)(enc("text"))
    for r in df.select("text", enc("text").alias("ids"), n("text").alias("n"), decoded.alias("back")).collect():
        assert r.n == (None if r.ids is None else len(r.ids)) and r.back == r.text
    escaped = df.select(bpe.encode_column(spark, model, "escape")("text").alias("ids"),
                        bpe.token_count_column(spark, model, "escape")("text").alias("n"))
    assert all(r.n == (None if r.ids is None else len(r.ids)) for r in escaped.collect())


def test_cached_words_are_packed():
    import pyarrow as pa

    from corpusforge.functions.bytelevel import bpe_segment

    merges = greedy({"abab": 3, "Ġab": 2}, 3)
    model = bpe.BpeModel(["<|eos|>"], sorted(set(bpe.BYTE_CHARS) - {"z"}), merges)
    ranks, cache = model.ranks(), {}
    rows = [["abab", " ab", "<|eos|>", "zab"], None, [], ["z", "ab" * 50, "é漢", "abab"]]
    specials = {"<|eos|>": model.token_to_id["<|eos|>"]}
    got = bpe._encode_lists(pa.array(rows), model.token_to_id, ranks, specials, cache).to_pylist()
    parts = [None if r is None else [t for w in r for t in ([w] if w in specials else bpe_segment(to_symbols(w), ranks))] for r in rows]
    assert got == [None if r is None else [model.token_to_id[t] for t in r if t in model.token_to_id] for r in parts]
    # four bytes an id, no Python numbers
    assert all(type(v) is bytes and len(v) % 4 == 0 for v in cache.values()) and len(cache[b"zab"]) == 4


def test_kept_bpe_tokens_are_not_shuffled_again(spark):
    """The stream sum and the packing read the kept tokens as they lie."""
    import re

    from corpusforge.plans import corpus
    from conftest import docs as load_docs

    p = corpus.CorpusParams(context_length=64)
    d = load_docs(spark)
    model = bpe.BpeModel(["<|eos|>"], sorted(bpe.BYTE_CHARS), greedy({"the": 3, "Ġthe": 2}, 4))
    toks = corpus.tokenize_documents_bpe(corpus.split_documents(d, p), model, p, by_bucket=True)
    seqs = corpus.packed(corpus.streamed_documents(toks), p, texts=True)
    rows = seqs.collect()
    plan = seqs._jdf.queryExecution().executedPlan().toString()
    toks.unpersist()
    assert rows and "InMemoryRelation" in plan
    # shuffles that were run, not those of the plan before the tokens were kept
    assert not re.search(r"ShuffleQueryStage \d+[^\n]*\n[^\n]*Exchange hashpartitioning\(split#\d+, _bucket", plan)


def test_many_words_are_segmented_without_a_cache(monkeypatch):
    import pyarrow as pa

    model = bpe.BpeModel(["<|eos|>", "<|unused|>"], sorted(set(bpe.BYTE_CHARS) - {"z"}), greedy({"abab": 3, "Ġab": 2}, 3))
    ranks, t2i = model.ranks(), model.token_to_id
    specials = {s: t2i[s] for s in model.specials}
    rnd = random.Random(3)
    words = ["".join(rnd.choice([*"abz ", "é", "漢", "ab"]) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    rows = [rnd.sample(words, 5) + rnd.choice([[], ["<|eos|>", "ab" * 50], ["z"]]) for _ in range(200)] + [None, []]
    want = bpe._encode_lists(pa.array(rows), t2i, ranks, specials, {}).to_pylist()
    monkeypatch.setattr(bpe, "_FEW_WORDS", 0)
    monkeypatch.setattr(bpe, "_SYMBOLS", 50)
    for few in (1024, 0):                       # pairs looked up in a table, or searched
        monkeypatch.setattr("corpusforge.functions.bytelevel.FEW_SYMBOLS", few)
        monkeypatch.setattr(bpe, "_MERGES", {})
        cache = {}
        assert bpe._encode_lists(pa.array([["skipped"], *rows]).slice(1), t2i, ranks, specials, cache).to_pylist() == want
        assert all(len(w) > 40 or w == b"<|eos|>" for w in cache)
