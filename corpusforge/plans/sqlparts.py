"""DuckDB-side statements of our operators, used as oracles.

Each helper returns SQL text (CTE bodies) that states the same result as a
Spark operator.  Kept beside the queries so the two sides are read together.
"""

from __future__ import annotations

from corpusforge.functions.text import NON_WS_PATTERN, STRIP_PATTERN
from corpusforge.operators.wordtok import WORD_PATTERN


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {q(STRIP_PATTERN)}, '', 'g')"


def non_blank_sql(expr: str) -> str:
    return f"regexp_matches({expr}, {q(NON_WS_PATTERN)})"


def words_sql(expr: str) -> str:
    return f"regexp_extract_all({expr}, {q(WORD_PATTERN)})"


def key_sql(seed, id_expr: str) -> str:
    return f"md5(concat_ws(':', {q(str(seed))}, CAST({id_expr} AS VARCHAR)))"


def split_docs_cte(seed=42, val_ratio=0.01, table="documents", id_col="doc_id") -> str:
    """Kept documents with pos, n_total and split (P2 + D1 + D5)."""
    return f"""
    kept AS (SELECT * FROM {table} WHERE {non_blank_sql('text')}),
    ordered AS (
      SELECT *, {key_sql(seed, id_col)} AS order_key,
             row_number() OVER (ORDER BY {key_sql(seed, id_col)}, {id_col}) - 1 AS pos,
             count(*) OVER () AS n_total
      FROM kept),
    split_docs AS (
      SELECT *, CASE WHEN pos < n_total - floor(n_total * {float(val_ratio)!r}) THEN 'train'
                     ELSE 'validation' END AS split
      FROM ordered)"""


def word_vocab_cte(vocab_size=4096, cap=None, min_frequency=1) -> str:
    """Vocabulary over the train split, or its first ``cap`` documents (needs split_docs)."""
    specials = ["<|pad|>", "<|unk|>", "<|bos|>", "<|eos|>", "<|user|>", "<|assistant|>"]
    spec_rows = ", ".join(f"({i}, {q(s)}, 'special')" for i, s in enumerate(specials))
    k = vocab_size - len(specials)
    spec_list = ", ".join(q(s) for s in specials)
    return f"""
    sample_docs AS (SELECT * FROM split_docs WHERE split = 'train'{'' if cap is None else f' AND pos < {cap}'}),
    sample_words AS (SELECT unnest({words_sql('text')}) AS word FROM sample_docs),
    counts AS (SELECT word, count(*) AS freq FROM sample_words GROUP BY word),
    ranked AS (
      SELECT word, freq, row_number() OVER (ORDER BY freq DESC, word ASC) AS rn
      FROM counts WHERE freq >= {min_frequency} AND word NOT IN ({spec_list})),
    vocab AS (
      SELECT * FROM (VALUES {spec_rows}) AS s(token_id, token, kind)
      UNION ALL
      SELECT CAST(rn + {len(specials) - 1} AS INTEGER), word, 'word' FROM ranked WHERE rn <= {k})"""


def doc_tokens_cte(double=False) -> str:
    """Per-document token rows ``doc_id, split, pos, j, tok`` (framed),
    needs split_docs and vocab."""
    n = 2 if double else 1
    return f"""
    doc_words AS (
      SELECT doc_id, split, pos, order_key, unnest(w) AS word, unnest(generate_series(1, len(w))) AS wp
      FROM (SELECT doc_id, split, pos, order_key, {words_sql('text')} AS w FROM split_docs)),
    doc_ids AS (
      SELECT d.doc_id, d.split, d.pos, d.wp, coalesce(v.token_id, 1) AS tok
      FROM doc_words d LEFT JOIN vocab v ON v.token = d.word),
    doc_len AS (
      SELECT doc_id, split, pos, order_key, len({words_sql('text')}) + {2 * n} AS n_tokens FROM split_docs),
    framed AS (
      SELECT doc_id, split, pos, wp + {n - 1} AS j, tok FROM doc_ids
      UNION ALL SELECT doc_id, split, pos, b, 2 FROM doc_len, range(0, {n}) t(b)
      UNION ALL SELECT doc_id, split, pos, n_tokens - 1 - b, 3 FROM doc_len, range(0, {n}) t(b)),
    streamed AS (
      SELECT doc_id, split, pos, n_tokens,
             CAST(sum(n_tokens) OVER (PARTITION BY split ORDER BY order_key, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n_tokens AS BIGINT) AS tok_offset,
             CAST(sum(n_tokens) OVER (PARTITION BY split) AS BIGINT) AS tok_total
      FROM doc_len),
    stream_tokens AS (
      SELECT f.split, s.tok_offset + f.j AS t, f.tok, s.tok_total
      FROM framed f JOIN streamed s USING (doc_id))"""


def packed_cte(length: int, stride: int | None = None) -> str:
    """Packed sequences as strings (needs stream_tokens)."""
    L, S = length, (stride or length)
    return f"""
    tok_seq AS (
      SELECT split, t, tok, unnest(generate_series(
               greatest(CAST(ceil((t - {L}) / {S}.0) AS BIGINT), 0),
               least(CAST(floor(t / {S}.0) AS BIGINT),
                     greatest(CAST(floor((tok_total - {L} - 1) / {S}.0) AS BIGINT) + 1, 0) - 1))) AS seq_id
      FROM stream_tokens),
    packed AS (
      SELECT split, seq_id,
             string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY t) FILTER (WHERE t < seq_id * {S} + {L}) AS input_ids,
             string_agg(CAST(tok AS VARCHAR), ' ' ORDER BY t) FILTER (WHERE t > seq_id * {S}) AS target_ids
      FROM tok_seq GROUP BY split, seq_id)"""


def encode_cols_cte(name: str, src: str, key: str, cols) -> str:
    """CTE ``name(key, <col>_ids...)``: word-tokenizer ids per column (needs vocab)."""
    parts = " UNION ALL ".join(
        f"SELECT {key} AS k, {i} AS c, unnest({words_sql(c)}) AS w, "
        f"unnest(generate_series(1, len({words_sql(c)}))) AS p FROM {src}"
        for i, c in enumerate(cols))
    aggs = ", ".join(
        f"coalesce(list(t.tok ORDER BY t.p) FILTER (WHERE t.c = {i}), []::INTEGER[]) AS {c}_ids"
        for i, c in enumerate(cols))
    return f"""
    {name}_w AS ({parts}),
    {name}_t AS (SELECT x.k, x.c, x.p, coalesce(v.token_id, 1) AS tok
                 FROM {name}_w x LEFT JOIN vocab v ON v.token = x.w),
    {name} AS (SELECT s.{key} AS {key}, {aggs}
               FROM {src} s LEFT JOIN {name}_t t ON t.k = s.{key} GROUP BY s.{key})"""


def chat_pairs_cte() -> str:
    return """
    pairs AS (
      SELECT u.conv_id * 4294967296 + u.turn AS index, u.conv_id, u.turn, u.text AS instruction, a.text AS response
      FROM conversations u JOIN conversations a
        ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
      WHERE u.role = 'user')"""


def hash_mod_sql(n: int, seed, expr: str, salt: str = "") -> str:
    parts = [q(str(seed))] + ([q(salt)] if salt else []) + [f"CAST({expr} AS VARCHAR)"]
    h = f"md5(concat_ws(':', {', '.join(parts)}))"
    return f"(CAST('0x' || substr({h}, 1, 15) AS BIGINT) % {n})"


def ids_sql(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"
