"""Registered queries: text functions, prompts, SFT rows and preference rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import text as X
from corpusforge.operators import prefs, prompts, sft, wordtok
from corpusforge.plans import corpus
from corpusforge.plans import sqlparts as S
from corpusforge.plans.queries import CORPUS, ids_str, register, table
from corpusforge.sources import seeds

M_SFT = 64
M_DPO = 64
_VOCAB_SQL = f"{S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}"


def _vocab(spark, d):
    return corpus.train_word_vocab(table(spark, d, "documents"), CORPUS)


# ------------------------------------------------------------ text functions

@register("p5_strip_quotes", f"""
SELECT conv_id, turn, CASE WHEN starts_with(s, '"') AND ends_with(s, '"')
                          THEN substr(s, 2, greatest(length(s) - 2, 0)) ELSE s END AS cleaned
FROM (SELECT conv_id, turn, {S.strip_sql('text')} AS s FROM conversations)""")
def q_p5(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", X.strip_wrapping_quotes("text").alias("cleaned"))


@register("p6_fenced_payload", f"""
SELECT conv_id, turn, CASE WHEN starts_with(s, '```') THEN {S.strip_sql("CASE WHEN starts_with(pc, 'json') THEN substr(pc, 5) ELSE pc END")}
                          ELSE s END AS payload
FROM (SELECT conv_id, turn, s, coalesce(string_split(s, '```')[2], '') AS pc
      FROM (SELECT conv_id, turn, {S.strip_sql('text')} AS s FROM conversations))""")
def q_p6(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", X.fenced_payload("text").alias("payload"))


@register("p7_json_required_keys", """
SELECT event_id,
       coalesce(json_valid(props) AND json_type(props) = 'OBJECT' AND json_exists(props, '$.k'), false) AS has_k,
       coalesce(json_valid(props) AND json_type(props) = 'OBJECT' AND json_exists(props, '$.k')
                AND json_exists(props, '$.missing'), false) AS has_k_and_missing,
       json_extract_string(props, '$.k') AS k
FROM events""")
def q_p7(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", X.has_keys("props", ["k"]).alias("has_k"),
                    X.has_keys("props", ["k", "missing"]).alias("has_k_and_missing"),
                    X.parse_object("props", ["k"])["k"].alias("k"))


@register("p8_scrub_tokens", f"""
SELECT conv_id, turn, ltrim({S.strip_sql("replace(replace(replace(text, '<|eos|>', ''), '<|pad|>', ''), '<|bos|>', '')")}, '.,;:!?') AS scrubbed
FROM conversations""")
def q_p8(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", X.scrub_tokens("text", [X.EOS, X.PAD, X.BOS], ".,;:!?").alias("scrubbed"))


@register("p9_chat_template", f"""
WITH {S.chat_pairs_cte().strip()}
SELECT index, '<|bos|><|user|>' || instruction || '<|assistant|>' AS prompt_text,
       '<|bos|><|user|>' || instruction || '<|assistant|>' || response || '<|eos|>' AS full_text,
       '<|bos|>' || instruction AS base_text
FROM pairs""")
def q_p9(spark, d):
    p = sft.chat_pairs(table(spark, d, "conversations"))
    return p.select("index", X.chat_text("instruction").alias("prompt_text"),
                    X.chat_text("instruction", "response").alias("full_text"),
                    X.chat_text("instruction", mode="base").alias("base_text"))


@register("p4_story_prompts", f"""
SELECT doc_id AS index, {S.q(prompts.STORY_TEMPLATE.split('{story}')[0])} || left(text, 2000)
       || {S.q(prompts.STORY_TEMPLATE.split('{story}')[1])} AS prompt, length(text) AS response_chars
FROM documents""")
def q_p4(spark, d):
    sp = prompts.story_prompts(table(spark, d, "documents"), max_chars=2000)
    return sp.select("index", "prompt", F.length("response").cast("long").alias("response_chars"))


def _task_prompt_sql() -> str:
    t = prompts.TASK_TEMPLATE
    out, pos = [], 0
    import re
    for m in re.finditer(r"\{(\w+)\}", t):
        out.append(S.q(t[pos:m.start()]))
        out.append({"name": "c.category", "topic": "tp.topic"}[m.group(1)])
        pos = m.end()
    out.append(S.q(t[pos:]))
    return " || ".join(out)


@register("p14_task_grid", f"""
WITH cats AS (SELECT lang AS category, row_number() OVER (ORDER BY lang) - 1 AS category_id
              FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
     tops AS (SELECT source AS topic, row_number() OVER (ORDER BY source) - 1 AS topic_id
              FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
     grid AS (SELECT doc_id AS index, {S.hash_mod_sql('(SELECT count(*) FROM cats)', 42, 'doc_id', 'c')} AS category_id,
                     {S.hash_mod_sql('(SELECT count(*) FROM tops)', 42, 'doc_id', 't')} AS topic_id FROM documents)
SELECT g.index, c.category, tp.topic, {_task_prompt_sql()} AS prompt
FROM grid g JOIN cats c ON c.category_id = g.category_id JOIN tops tp ON tp.topic_id = g.topic_id""")
def q_p14(spark, d):
    return prompts.task_grid(table(spark, d, "documents"), "doc_id", seed=42)


def _variation_sql() -> str:
    cases = " ".join(
        f"WHEN {i} THEN {S.q(v.split('{p}')[0])} || {'lower(b.base)' if v.startswith('Please') else 'b.base'} || {S.q(v.split('{p}')[1])}"
        for i, v in enumerate(seeds.VARIATIONS))
    return f"CASE g.variation_id {cases} END"


@register("p13_prompt_variations", f"""
WITH bases AS (SELECT * FROM (VALUES {', '.join(f'({i}, {S.q(b)})' for i, b in enumerate(seeds.BASE_PROMPTS))}) AS b(base_id, base)),
     grid AS (SELECT event_id AS index, CAST(event_id % 30 AS INTEGER) AS base_id,
                     CAST(floor(event_id / 30) % 5 AS INTEGER) AS variation_id FROM events)
SELECT g.index, g.base_id, g.variation_id, {_variation_sql()} AS prompt
FROM grid g JOIN bases b ON b.base_id = g.base_id""")
def q_p13(spark, d):
    return prompts.prompt_variations(table(spark, d, "events").select("event_id"), "event_id")


# ------------------------------------------------------------------ SFT rows

def _sft_rows(spark, d):
    pairs = sft.chat_pairs(table(spark, d, "conversations"))
    enc = wordtok.encode_columns(pairs, ["instruction", "response"], _vocab(spark, d), ["index"],
                                 vocab_size_bound=CORPUS.vocab_size)
    return sft.sft_rows(enc, "instruction_ids", "response_ids", M_SFT)


_SFT_SQL = f"""WITH {_VOCAB_SQL}, {S.chat_pairs_cte().strip()},
    {S.encode_cols_cte('enc', 'pairs', 'index', ['instruction', 'response']).strip()},
    full_rows AS (SELECT index, [2, 4] || instruction_ids || [5] || response_ids || [3] AS f,
                         len(instruction_ids) AS ilen FROM enc),
    cut AS (SELECT index, len(f) > {M_SFT} AS truncated,
                   CASE WHEN len(f) > {M_SFT} THEN f[1:{M_SFT - 1}] || [3] ELSE f END AS t, ilen FROM full_rows),
    padded AS (SELECT index, truncated, len(t) AS n_tokens, least(ilen + 3, len(t)) AS instr_len,
                      list_resize(t, {M_SFT}, 0) AS p FROM cut),
    masks AS (
      SELECT index, string_agg(CAST(CASE WHEN i < instr_len - 1 THEN 0 WHEN x = 0 THEN 0 ELSE 1 END AS VARCHAR),
                               ' ' ORDER BY i) AS loss_mask
      FROM (SELECT index, instr_len, unnest(p[2:{M_SFT}]) AS x, unnest(range(0, {M_SFT - 1})) AS i FROM padded)
      GROUP BY index)"""


@register("f1_f5_sft_rows", _SFT_SQL + f"""
SELECT p.index, p.n_tokens, p.instr_len, p.truncated, {S.ids_sql('p.p[1:' + str(M_SFT - 1) + ']')} AS input_ids,
       {S.ids_sql('p.p[2:' + str(M_SFT) + ']')} AS target_ids, m.loss_mask
FROM padded p JOIN masks m USING (index)""")
def q_f15(spark, d):
    r = _sft_rows(spark, d)
    return r.select("index", F.col("n_tokens").cast("long").alias("n_tokens"),
                    F.col("instr_len").cast("long").alias("instr_len"), "truncated",
                    ids_str("input_ids").alias("input_ids"),
                    ids_str("target_ids").alias("target_ids"),
                    ids_str(F.transform("loss_mask", lambda x: x.cast("int"))).alias("loss_mask"))


@register("f6_sft_stats", _SFT_SQL + f"""
SELECT count(*) AS n_rows, round(avg(n_tokens), 6) AS avg_len, CAST(max(n_tokens) AS INTEGER) AS max_len,
       count(CASE WHEN n_tokens >= {M_SFT} THEN 1 END) AS at_or_over_max,
       count(CASE WHEN n_tokens = {M_SFT} AND NOT truncated THEN 1 END) AS exact_max,
       count(CASE WHEN truncated THEN 1 END) AS truncated
FROM padded""")
def q_f6(spark, d):
    return sft.sft_stats(_sft_rows(spark, d), M_SFT)


@register("f9_chat_pairs", f"""
WITH {S.chat_pairs_cte().strip()} SELECT index, conv_id, turn, instruction, response FROM pairs""")
def q_f9(spark, d):
    return sft.chat_pairs(table(spark, d, "conversations"))


# ----------------------------------------------------------- preference rows

_PAIRS_SQL = f"""{S.chat_pairs_cte().strip()},
    ordered_pairs AS (SELECT *, row_number() OVER (ORDER BY {S.key_sql(42, 'index')}, index) - 1 AS pos,
                             count(*) OVER () AS n FROM pairs),
    response_pairs AS (
      SELECT a.index, a.instruction AS prompt, a.response AS response_a, b.response AS response_b
      FROM ordered_pairs a JOIN ordered_pairs b ON b.pos = (a.pos + 1) % a.n),
    verdicts AS (
      SELECT index, CASE WHEN (instr('0123456789abcdef', substr(md5(CAST(index AS VARCHAR)), 1, 1)) - 1) % 2 = 0
                         THEN 'A' ELSE 'B' END AS verdict FROM response_pairs),
    preferences AS (
      SELECT r.index, r.prompt,
             CASE WHEN v.verdict = 'A' THEN r.response_a ELSE r.response_b END AS chosen,
             CASE WHEN v.verdict = 'A' THEN r.response_b ELSE r.response_a END AS rejected
      FROM response_pairs r JOIN verdicts v USING (index)
      WHERE {S.non_blank_sql('r.response_a')} AND {S.non_blank_sql('r.response_b')}
        AND r.response_a <> r.response_b)"""


def _preferences(spark, d):
    pairs = sft.chat_pairs(table(spark, d, "conversations"))
    responses = prefs.derive_response_pairs(pairs, "index", seed=42)
    verdicts = responses.select("index", prefs.stub_verdict("index").alias("verdict"))
    return prefs.preference_join(responses, verdicts, "index")


@register("g6_g8_preference_pairs", f"""WITH {_PAIRS_SQL}
SELECT index, prompt, chosen, rejected FROM preferences""")
def q_g8(spark, d):
    return _preferences(spark, d)


def _pref_rows_sql(label_mode: str, eos_on_truncate: bool) -> str:
    M = M_DPO
    resp = {}
    for side in ("chosen", "rejected"):
        r = f"({side}_ids || [3])"
        if eos_on_truncate:
            r = (f"(CASE WHEN {M} - plen <= 0 THEN []::INTEGER[] WHEN len({r}) > {M} - plen "
                 f"THEN {r}[1:greatest({M} - plen - 1, 0)] || [3] ELSE {r} END)")
        resp[side] = r
    sel = []
    for side in ("chosen", "rejected"):
        full = f"(p || {resp[side]})"
        labels = f"(list_resize([]::INTEGER[], plen, -100) || {resp[side]})" if label_mode == "response" else full
        sel.append(f"{S.ids_sql(f'list_resize({full}, {M}, 0)')} AS {side}_input_ids")
        sel.append(f"{S.ids_sql(f'list_resize({labels}, {M}, -100)')} AS {side}_labels")
    return f"""WITH {_VOCAB_SQL}, {_PAIRS_SQL},
    {S.encode_cols_cte('enc', 'preferences', 'index', ['prompt', 'chosen', 'rejected']).strip()},
    pr AS (SELECT index, [2, 4] || prompt_ids || [5] AS p, len(prompt_ids) + 3 AS plen, chosen_ids, rejected_ids
           FROM enc)
SELECT index, plen >= {M} AS prompt_overflow, {', '.join(sel)} FROM pr"""


def _pref_rows(spark, d, label_mode, eos):
    p = _preferences(spark, d)
    enc = wordtok.encode_columns(p, ["prompt", "chosen", "rejected"], _vocab(spark, d), ["index"],
                                 vocab_size_bound=CORPUS.vocab_size)
    rows = prefs.preference_rows(enc, "prompt_ids", "chosen_ids", "rejected_ids", M_DPO, label_mode, eos)
    return rows.select("index", "prompt_overflow",
                       *[ids_str(c).alias(c) for c in ("chosen_input_ids", "chosen_labels",
                                                        "rejected_input_ids", "rejected_labels")])


@register("g1_g4_preference_rows", _pref_rows_sql("response", True))
def q_g14(spark, d):
    return _pref_rows(spark, d, "response", True)


@register("g5_single_string_rows", _pref_rows_sql("all", False))
def q_g5(spark, d):
    return _pref_rows(spark, d, "all", False)
