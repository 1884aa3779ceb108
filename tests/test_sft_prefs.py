import pytest

from corpusforge.operators import prefs, sft

BOS, EOS, USER, ASSIST, PAD = 2, 3, 4, 5, 0


def ref_sft(instr, resp, M, mask=True):
    tokens = [BOS, USER] + instr + [ASSIST] + resp + [EOS]
    ilen = 2 + len(instr) + 1
    if len(tokens) > M:
        tokens = tokens[:M - 1] + [EOS]
    ilen = min(ilen, len(tokens))
    padded = tokens + [PAD] * (M - len(tokens))
    inp, tgt = padded[:-1], padded[1:]
    m = [1.0] * len(tgt)
    if mask:
        for i in range(ilen - 1):
            m[i] = 0.0
    m = [0.0 if t == PAD else v for t, v in zip(tgt, m)]
    return inp, tgt, m, len(tokens)


M = 12
SFT_CASES = [([10, 11], [20] * (M - 7)), ([10, 11], [20] * (M - 6)), ([10, 11], [20] * (M - 5)),
             ([10] * (M + 2), [20, 21]), ([10, 11], []), ([], [])]


def test_sft_rows_match_reference_semantics(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(SFT_CASES)]
    df = spark.createDataFrame(rows, "index long, i_ids array<int>, r_ids array<int>")
    got = sft.sft_rows(df, "i_ids", "r_ids", M).orderBy("index").collect()
    for r, (a, b) in zip(got, SFT_CASES):
        inp, tgt, m, n = ref_sft(a, b, M)
        assert list(r.input_ids) == inp and list(r.target_ids) == tgt
        assert [float(x) for x in r.loss_mask] == m and r.n_tokens == n
    stats = sft.sft_stats(sft.sft_rows(df, "i_ids", "r_ids", M), M).first()
    assert stats.exact_max == 1 and stats.truncated == 2 and stats.at_or_over_max == 3


def test_sft_stats_empty_is_null(spark):
    df = spark.createDataFrame([], "index long, i_ids array<int>, r_ids array<int>")
    s = sft.sft_stats(sft.sft_rows(df, "i_ids", "r_ids", M), M).first()
    assert s.n_rows == 0 and s.avg_len is None


def test_chat_pairs(spark):
    conv = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"),
                                  (1, 3, "user", "u2"), (2, 0, "user", "x"), (2, 1, "user", "y"),
                                  (2, 2, "assistant", "z"), (1, 2001, "user", "late"), (1, 2002, "assistant", "r")],
                                 "conv_id long, turn long, role string, text string")
    got = sorted((r["index"], r.instruction, r.response) for r in sft.chat_pairs(conv).collect())
    # one key per (conversation, turn), also beyond 1,000 turns
    assert got == [(2 ** 32 + 1, "u1", "a1"), (2 ** 32 + 2001, "late", "r"), (2 * 2 ** 32 + 1, "y", "z")]


def ref_pref(p, c, r, M):
    pt = [BOS, USER] + p + [ASSIST]
    out = []
    for resp in (c + [EOS], r + [EOS]):
        m = M - len(pt)
        if len(resp) > m:
            resp = resp[:m - 1] + [EOS]
        full = pt + resp
        full = full[:M] if len(full) >= M else full + [PAD] * (M - len(full))
        lab = [-100] * len(pt) + resp
        lab = lab[:M] if len(lab) >= M else lab + [-100] * (M - len(lab))
        out += [full, lab]
    return out


@pytest.mark.parametrize("plen", [M - 2 - 3, M - 1 - 3, M - 3, M + 5 - 3, 2])
def test_preference_rows_match_reference_semantics(spark, plen):
    p, c, r = [30] * plen, [40] * 7, []
    df = spark.createDataFrame([(0, p, c, r)], "index long, p array<int>, c array<int>, r array<int>")
    got = prefs.preference_rows(df, "p", "c", "r", M).first()
    exp = ref_pref(p, c, r, M)
    assert [list(got.chosen_input_ids), list(got.chosen_labels), list(got.rejected_input_ids),
            list(got.rejected_labels)] == exp
    assert got.prompt_overflow == (plen + 3 >= M)


def test_single_string_variant(spark):
    df = spark.createDataFrame([(0, [30] * 3, [40] * 20, [41])], "index long, p array<int>, c array<int>, r array<int>")
    got = prefs.preference_rows(df, "p", "c", "r", M, label_mode="all", eos_on_truncate=False).first()
    assert list(got.chosen_input_ids) == [BOS, USER, 30, 30, 30, ASSIST] + [40] * 6
    assert list(got.rejected_labels) == [BOS, USER, 30, 30, 30, ASSIST, 41, EOS] + [-100] * 4


def test_preference_join_and_dedupe(spark):
    resp = spark.createDataFrame([(1, "p", "a", "b"), (2, "p", "a", "a"), (3, "p", "x", " ")],
                                 "index long, prompt string, response_a string, response_b string")
    verd = spark.createDataFrame([(1, "B", 2), (1, "A", 1), (2, "A", 1), (3, "A", 1)],
                                 "index long, verdict string, verdict_id int")
    got = prefs.preference_join(resp, prefs.dedupe_verdicts(verd)).collect()
    assert [(r["index"], r.chosen, r.rejected) for r in got] == [(1, "a", "b")]


def test_turn_keys_stay_apart(spark):
    df = spark.createDataFrame([(1, 1001), (2, 1), (1, 10 ** 9), (1000, 5)], "conv_id long, turn long")
    keys = [r["index"] for r in df.orderBy("conv_id", "turn").select(sft.turn_key().alias("index")).collect()]
    assert len(set(keys)) == 4 and keys == sorted(keys)
