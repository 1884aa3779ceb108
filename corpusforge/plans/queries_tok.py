"""Registered queries: byte-level BPE and tokenizer reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions.text import CHAT_SPECIALS, STORY_SPECIALS, USER, ASSISTANT
from corpusforge.operators import bpe, vocab as V, wordtok
from corpusforge.plans import corpus
from corpusforge.plans import bpesql as B
from corpusforge.plans import sqlparts as S
from corpusforge.plans.queries import CORPUS, ids_str, register, table
from corpusforge.session import cut_lineage, spread

BPE_MERGES = 64
_MODELS: dict[tuple, bpe.BpeModel] = {}


def _version(spark, path: str) -> tuple:
    """Number, size and newest change of a table's files (one row)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return tuple(files.agg(F.count("path"), F.sum("length"), F.max("modificationTime"), F.sum(F.hash("path").cast("long"))).first())


def bpe_model(spark, d, merges: int = BPE_MERGES) -> bpe.BpeModel:
    """T2 + T3 on the D9 sample of the documents; kept while the files stay the same."""
    key = (d, merges, _version(spark, f"{d.rstrip('/')}/documents.parquet"))
    if key not in _MODELS:
        sample = corpus.tokenizer_sample(table(spark, d, "documents"), CORPUS)
        words = bpe.pretoken_counts(sample, "text")
        _MODELS[key] = bpe.train_bpe(words, vocab_size=len(CHAT_SPECIALS) + 256 + merges, min_frequency=2)
    return _MODELS[key]


_WSU = B.WSU
# The pre-tokenisation pattern without its look-ahead: a whitespace run is one
# token.  The look-ahead version splits the last character off a run of two
# or more that precedes a non-space; when that character is a space it joins
# the next token (same count), otherwise it is a token of its own (+1).
_RE2_PRETOK = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WSU + r"\p{L}\p{N}]+|[" + _WSU + "]+")
_RE2_RUNS = "([" + _WSU + "]+)[^" + _WSU + "]"


@register("t1_pretokenize", f"""
SELECT doc_id,
       CAST(len(regexp_extract_all(text, {S.q(_RE2_PRETOK)}))
            + len(list_filter(regexp_extract_all(text, {S.q(_RE2_RUNS)}, 1),
                              lambda r: length(r) >= 2 AND right(r, 1) <> ' ')) AS INTEGER) AS n_pretokens,
       array_to_string(regexp_extract_all(text, {S.q(_RE2_PRETOK)}), '') = text AS lossless
FROM documents""")
def q_t1(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    toks = bpe.pretokens("text")
    return docs.select("doc_id", F.size(toks).alias("n_pretokens"),
                       (F.array_join(toks, "") == F.col("text")).alias("lossless"))


def _bpe_sql(*texts: str) -> str:
    return f"WITH {S.split_docs_cte().strip()}, {B.train_cte(BPE_MERGES, list(texts))}"


@register("t3_bpe_merges", _bpe_sql() + """
SELECT rank, l AS "left", r AS "right" FROM bpe_merges""")
def q_t3(spark, d):
    return bpe_model(spark, d).merges_df(spark)


@register("t3_bpe_merges_2048")
def q_t3_large(spark, d):
    """A vocabulary of real size, exact; SQL states the same rule for 64 merges."""
    return bpe_model(spark, d, 2048).merges_df(spark)


@register("s7_vocab_merges", _bpe_sql() + """
SELECT 'merge' AS kind, rank AS place, l || r AS token FROM bpe_merges
UNION ALL SELECT 'token', token_id, token FROM bpe_ids""")
def q_s7_merges(spark, d):
    """A learned vocabulary with its merges, written as a tokenizer folder, read
    back into a model and listed from that (S7)."""
    from corpusforge.session import scratch_path
    from corpusforge.sources import io

    path, model = scratch_path(spark, "tokenizer"), bpe_model(spark, d)
    io.write_vocab(model.vocab_df(spark), model.merges_df(spark), path)
    back = bpe.BpeModel.from_frames(*io.read_vocab(spark, path))
    merges = back.merges_df(spark).select(F.lit("merge").alias("kind"), F.col("rank").alias("place"),
                                          F.concat("left", "right").alias("token"))
    return merges.unionByName(back.vocab_df(spark).select(F.lit("token").alias("kind"), F.col("token_id").alias("place"), "token"))


@register("t5_bpe_encode", _bpe_sql("SELECT text FROM documents") + f""",
    {B.encode_cte('enc', 'documents', 'doc_id', 'text')}
SELECT k AS doc_id, CAST(len(ids) + 2 AS INTEGER) AS n_tokens, {S.ids_sql('[2] || ids || [3]')} AS ids FROM enc""")
def q_t5(spark, d):
    model = bpe_model(spark, d)
    enc = bpe.encode_column(spark, model)
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    ids = bpe.frame(enc("text"))
    return docs.select("doc_id", F.size(ids).alias("n_tokens"), ids_str(ids).alias("ids"))


@register("t7_bpe_decode_roundtrip", """
SELECT doc_id, text = text AS roundtrip_equal FROM documents""")
def q_t7(spark, d):
    model = bpe_model(spark, d)
    enc, dec = bpe.encode_column(spark, model), bpe.decode_column(spark, model)
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    back = docs.select("doc_id", "text", dec(enc("text")).alias("back"))
    return back.select("doc_id", (F.col("back") == F.col("text")).alias("roundtrip_equal"))


@register("t9_example_report", _bpe_sql("SELECT text FROM benchmark") + f""",
    {B.encode_cte('enc', 'benchmark', 'item_id', 'text')},
    named AS (SELECT k, string_agg(b.token, ' ' ORDER BY p) AS tokens
              FROM (SELECT k, unnest(ids) AS token_id, unnest(range(0, len(ids))) AS p FROM enc)
              JOIN bpe_ids b USING (token_id) GROUP BY k)
SELECT s.item_id, s.text, {S.ids_sql('e.ids')} AS ids, coalesce(n.tokens, '') AS tokens,
       CAST(len(e.ids) AS INTEGER) AS n_tokens
FROM benchmark s JOIN enc e ON e.k = s.item_id LEFT JOIN named n ON n.k = s.item_id""")
def q_t9(spark, d):
    model = bpe_model(spark, d)
    rep = bpe.example_report(table(spark, d, "benchmark").select("item_id", "text"), bpe.encode_column(spark, model),
                             model.vocab_df(spark), "item_id")
    return rep.select("item_id", "text", ids_str("ids").alias("ids"), F.array_join("tokens", " ").alias("tokens"),
                      "n_tokens")


@register("t4_special_append", f"""
WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
  story AS (
    SELECT * FROM (VALUES {', '.join(f"({i}, {S.q(t)}, 'special')" for i, t in enumerate(STORY_SPECIALS))})
      AS s(token_id, token, kind)
    UNION ALL SELECT token_id - 1, token, kind FROM vocab WHERE kind = 'word'),
  added AS (SELECT t.token, t.o FROM (VALUES ({S.q(USER)}, 0), ({S.q(ASSISTANT)}, 1)) AS t(token, o)
            WHERE t.token NOT IN (SELECT token FROM story))
SELECT token_id, token, kind FROM story
UNION ALL
SELECT CAST((SELECT max(token_id) FROM story) + row_number() OVER (ORDER BY o) AS INTEGER), token, 'special'
FROM added""")
def q_t4(spark, d):
    p = corpus.CorpusParams(vocab_size=4095)
    counts = wordtok.word_counts(corpus.tokenizer_sample(table(spark, d, "documents"), p), "text")
    story = wordtok.word_vocab(counts, 4095, 1, specials=STORY_SPECIALS)
    return V.append_specials(story, [USER, ASSISTANT])


_T8_SQL = f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
    lines AS (
      SELECT doc_id, ln, {S.strip_sql('raw')} AS line, row_number() OVER (ORDER BY doc_id, ln) - 1 AS line_pos
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                   unnest(range(0, len(string_split(text, chr(10))))) AS ln FROM documents)),
    firstn AS (SELECT * FROM lines WHERE {S.non_blank_sql('line')}),
    {S.encode_cols_cte('enc', 'firstn', 'line_pos', ['line']).strip()},
    framed AS (SELECT e.line_pos, f.line, [2] || e.line_ids || [3] AS ids
               FROM enc e JOIN firstn f USING (line_pos))"""


def _t8_encoded(spark, d):
    docs = table(spark, d, "documents")
    vocab = corpus.train_word_vocab(docs, CORPUS)
    lines = V.all_lines(spread(docs.select("doc_id", "text")), "doc_id", "text").withColumn("line_chars", F.length("line"))
    enc = wordtok.encode_words(lines, "line", vocab, ["doc_id", "ln"], vocab_size_bound=CORPUS.vocab_size,
                               carry=["line_chars"])
    # read by three aggregates of the report: written once
    enc = cut_lineage(enc.select("line_chars", wordtok.frame("ids").alias("ids")))
    return enc, vocab


@register("t8_report_summary", _T8_SQL + """
SELECT count(*) AS n_texts, CAST(sum(length(line)) AS BIGINT) AS n_chars, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
       round(sum(length(line)) / sum(len(ids)), 6) AS chars_per_token,
       (SELECT count(DISTINCT x) FROM (SELECT unnest(ids) AS x FROM framed)) AS distinct_ids,
       round((SELECT count(DISTINCT x) FROM (SELECT unnest(ids) AS x FROM framed)) * 100.0 / 4096, 6) AS coverage_pct
FROM framed""")
def q_t8(spark, d):
    enc, vocab = _t8_encoded(spark, d)
    summary, _ = bpe.tokenizer_report(enc, vocab, CORPUS.vocab_size, chars_col="line_chars")
    return summary


@register("t8_report_top_ids", _T8_SQL + """
SELECT t.token_id, t.n, v.token FROM (
  SELECT x AS token_id, count(*) AS n FROM (SELECT unnest(ids) AS x FROM framed) GROUP BY x
  ORDER BY n DESC, token_id LIMIT 20) t LEFT JOIN vocab v USING (token_id)""")
def q_t8b(spark, d):
    enc, vocab = _t8_encoded(spark, d)
    _, top = bpe.tokenizer_report(enc, vocab, CORPUS.vocab_size, chars_col="line_chars")
    return top.select("token_id", "n", "token")


@register("t8_first_lines", f"""
SELECT line_pos, doc_id, ln, {S.strip_sql('raw')} AS line FROM (
  SELECT doc_id, ln, raw, row_number() OVER (ORDER BY doc_id, ln) - 1 AS line_pos
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
               CAST(unnest(range(0, len(string_split(text, chr(10))))) AS INTEGER) AS ln FROM documents))
WHERE line_pos < 2000 AND {S.non_blank_sql('raw')}""")
def q_t8c(spark, d):
    """The reference's line limit on a report's input, as its own query."""
    return V.first_lines(table(spark, d, "documents"), "doc_id", "text", 2000)


@register("t6_double_framing", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}
SELECT doc_id, len({S.words_sql('text')}) + 4 AS n_tokens, split FROM split_docs""")
def q_t6(spark, d):
    p = corpus.CorpusParams(vocab_size=4096, double_framing=True)
    docs = table(spark, d, "documents")
    tok = corpus.tokenize_documents(corpus.split_documents(docs, p), corpus.train_word_vocab(docs, p), p)
    return tok.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "split")


@register("k5_vocab_dump", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}
SELECT CAST(token_id AS VARCHAR) || chr(9) ||
       replace(replace(replace(replace(token, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t')
       AS line
FROM vocab""")
def q_k5(spark, d):
    return V.vocab_dump(corpus.train_word_vocab(table(spark, d, "documents"), CORPUS))


@register("f8_extended_vocab_size", f"""WITH {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()}
SELECT count(*) + 2 AS vocab_size FROM vocab""")
def q_f8(spark, d):
    v = V.append_specials(corpus.train_word_vocab(table(spark, d, "documents"), CORPUS),
                         [*CHAT_SPECIALS, "<|tool|>", "<|turn end|>"])  # two that the vocabulary lacks (never one word)
    return v.agg(F.count(F.lit(1)).alias("vocab_size"))


X2_BOUND = 2000


@register("x2_greedy_chunks", f"""
WITH RECURSIVE lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(0, len(string_split(text, chr(10))))) AS ln FROM documents),
  walk(doc_id, ln, cur, chunk) AS (
    SELECT doc_id, ln, length(line), 0 FROM lines WHERE ln = 0
    UNION ALL
    SELECT l.doc_id, l.ln,
           CASE WHEN w.cur >= {X2_BOUND} THEN length(l.line) ELSE w.cur + length(l.line) END,
           CASE WHEN w.cur >= {X2_BOUND} THEN w.chunk + 1 ELSE w.chunk END
    FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.ln = w.ln + 1)
SELECT w.doc_id, CAST(w.chunk AS BIGINT) AS chunk_id, count(*) AS n_lines,
       CAST(sum(length(l.line)) AS BIGINT) AS n_chars
FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.ln = w.ln
GROUP BY w.doc_id, w.chunk""")
def q_x2(spark, d):
    from corpusforge.operators import chunking

    docs = table(spark, d, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line")).withColumn(
        "size", F.length("line"))
    lab = chunking.greedy_chunks(lines, "doc_id", "ln", "size", X2_BOUND)
    return lab.groupBy("doc_id", "chunk_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                                 F.sum("size").cast("long").alias("n_chars"))


@register("t10_chunk_encode", f"""
WITH RECURSIVE {S.split_docs_cte().strip()}, {S.word_vocab_cte(4096).strip()},
  lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(0, len(string_split(text, chr(10))))) AS ln FROM documents),
  walk(doc_id, ln, cur, chunk) AS (
    SELECT doc_id, ln, length(line), 0 FROM lines WHERE ln = 0
    UNION ALL
    SELECT l.doc_id, l.ln,
           CASE WHEN w.cur >= {X2_BOUND} THEN length(l.line) ELSE w.cur + length(l.line) END,
           CASE WHEN w.cur >= {X2_BOUND} THEN w.chunk + 1 ELSE w.chunk END
    FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.ln = w.ln + 1),
  toks AS (
    SELECT doc_id, chunk, coalesce(v.token_id, 1) AS tok, row_number() OVER (PARTITION BY doc_id, chunk ORDER BY ln, p) AS j
    FROM (SELECT w.doc_id, w.chunk, w.ln, unnest({S.words_sql('l.line')}) AS word,
                 unnest(range(0, len({S.words_sql('l.line')}))) AS p
          FROM walk w JOIN lines l ON l.doc_id = w.doc_id AND l.ln = w.ln) x
    LEFT JOIN vocab v ON v.token = x.word)
SELECT w.doc_id, CAST(w.chunk AS BIGINT) AS chunk_id, coalesce(t.ids, '') AS ids
FROM (SELECT DISTINCT doc_id, chunk FROM walk) w
LEFT JOIN (SELECT doc_id, chunk, string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY j) AS ids FROM toks GROUP BY ALL) t
  USING (doc_id, chunk)""")
def q_t10(spark, d):
    """The chunks of X2, each encoded on its own."""
    from corpusforge.operators import chunking

    docs = table(spark, d, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line")).withColumn(
        "size", F.length("line"))
    chunks = chunking.chunk_texts(chunking.greedy_chunks(lines, "doc_id", "ln", "size", X2_BOUND), "doc_id", "ln", "line")
    enc = wordtok.encode_words(chunks, "text", corpus.train_word_vocab(docs, CORPUS), ["doc_id", "chunk_id"],
                               vocab_size_bound=CORPUS.vocab_size)
    return enc.select("doc_id", "chunk_id", ids_str("ids").alias("ids"))


@register("c4_bpe_packed_sequences", _bpe_sql("SELECT text FROM split_docs") + f""",
    {B.stream_tokens_cte()}, {S.packed_cte(128).strip()}
SELECT split, seq_id, input_ids, target_ids FROM packed""")
def q_c4_bpe(spark, d):
    """The reference's pre-training path end to end with byte-level BPE:
    split -> BPE on the train split -> encode -> stream -> pack."""
    docs = table(spark, d, "documents")
    model = bpe_model(spark, d)
    toks = corpus.tokenize_documents_bpe(corpus.split_documents(docs, CORPUS), model, CORPUS, by_bucket=True)
    seqs = corpus.packed(corpus.streamed_documents(toks), CORPUS, texts=True)
    return seqs.select("split", "seq_id", "input_ids", "target_ids")


M_SFT_BPE = 256


@register("f1_f5_sft_rows_bpe", _bpe_sql("SELECT text FROM conversations") + f""",
    {S.chat_pairs_cte().strip()}, {B.encode_cte('i_enc', 'pairs', 'index', 'instruction')},
    {B.encode_cte('r_enc', 'pairs', 'index', 'response')},
    full_rows AS (SELECT i.k AS index, [2, 4] || i.ids || [5] || r.ids || [3] AS f, len(i.ids) AS ilen
                  FROM i_enc i JOIN r_enc r ON r.k = i.k),
    cut AS (SELECT index, ilen, len(f) > {M_SFT_BPE} AS truncated,
                   CASE WHEN len(f) > {M_SFT_BPE} THEN f[1:{M_SFT_BPE - 1}] || [3] ELSE f END AS t FROM full_rows)
SELECT index, CAST(len(t) AS INTEGER) AS n_tokens, CAST(least(ilen + 3, len(t)) AS INTEGER) AS instr_len, truncated,
       {S.ids_sql(f'list_resize(t, {M_SFT_BPE}, 0)[1:{M_SFT_BPE - 1}]')} AS input_ids
FROM cut""")
def q_f_bpe(spark, d):
    """Instruction rows with the BPE model; both columns are encoded by the
    row-wise Arrow UDF (no explode/regroup shuffle)."""
    from corpusforge.operators import sft

    model = bpe_model(spark, d)
    enc = bpe.encode_column(spark, model, "escape")  # user text cannot forge a role marker
    pairs = sft.chat_pairs(table(spark, d, "conversations"))
    ids = pairs.select("index", enc("instruction").alias("i_ids"), enc("response").alias("r_ids"))
    rows = sft.sft_rows(ids, "i_ids", "r_ids", M_SFT_BPE)
    return rows.select("index", "n_tokens", "instr_len", "truncated", ids_str("input_ids").alias("input_ids"))


@register("plan_sft_from_seeds")
def q_plan_sft(spark, d):
    """SURVEY 3.2 end to end: one task per document id (P14), a stub
    responder, parsing with an error table, BPE encoding, SFT rows, split."""
    from corpusforge.functions.responders import StubPairResponder
    from corpusforge.plans import instruct

    pairs, _errors = instruct.generate_pairs(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id",
                                             StubPairResponder(), max_in_flight=50)
    enc = bpe.encode_column(spark, bpe_model(spark, d), "escape")
    rows = instruct.sft_dataset(pairs, enc, max_length=256)
    return rows.select("index", "split", "n_tokens", "instr_len", "truncated")


@register("plan_preferences_from_prompts")
def q_plan_dpo(spark, d):
    """SURVEY 3.3 end to end over the benchmark prompts: D3 sample, two stub
    candidates each, a stub judge, parsed verdicts, preference rows."""
    from corpusforge.functions.responders import StubStyleResponder, StubVerdictResponder
    from corpusforge.plans import instruct

    bench = table(spark, d, "benchmark")
    pairs = instruct.response_pairs(bench, "item_id", "text", StubStyleResponder("gen"), n=bench.count())
    prefs_df, _unparsed = instruct.judge_preferences(pairs, StubVerdictResponder())
    enc = bpe.encode_column(spark, bpe_model(spark, d), "escape")
    rows = instruct.preference_dataset(prefs_df, enc, max_length=256)
    return rows.select("index", "split", "prompt_overflow",
                       F.size(F.filter("chosen_labels", lambda x: x != -100)).alias("chosen_scored"))


@register("t3_bpe_fast_vs_exact")
def q_t3_fast(spark, d):
    """The approximate fast mode against exact training on the same word
    table: merges in common, rounds, and the corpus size in tokens under
    each model (compression)."""
    exact = bpe_model(spark, d)
    sample = corpus.tokenizer_sample(table(spark, d, "documents"), CORPUS)
    words = bpe.pretoken_counts(sample, "text")
    fast = bpe.train_bpe(words, vocab_size=len(CHAT_SPECIALS) + 256 + BPE_MERGES, min_frequency=2,
                         mode="fast", fast_k=32)
    docs = spread(table(spark, d, "documents").select("text"))
    sizes = docs.select(bpe.token_count_column(spark, exact)("text").alias("e"),
                        bpe.token_count_column(spark, fast)("text").alias("f"))
    tot = sizes.agg(F.sum("e").cast("long").alias("exact_tokens"), F.sum("f").cast("long").alias("fast_tokens"))
    shared = len(set(exact.merges) & set(fast.merges))
    return tot.select(F.lit(len(exact.merges)).alias("n_merges"), F.lit(shared).alias("shared_merges"),
                      F.lit(exact.rounds).alias("exact_rounds"), F.lit(fast.rounds).alias("fast_rounds"),
                      "exact_tokens", "fast_tokens")
