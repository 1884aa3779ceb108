"""DuckDB-side statement of byte-level BPE (T1-T5), used as an oracle.

One merge per step, the plain rule: count adjacent symbol pairs weighted by
word frequency, take the most frequent (ties: left, then right symbol), rewrite
every word, repeat.  A word is a string of symbols wrapped as U+0002 symbol
U+0003, so ``replace`` rewrites occurrences left to right without overlap.  The
words of the texts to encode ride along with frequency 0, so the last step's
words are the segmentation.  U+0001 to U+0003 in a text are not covered.
"""

from __future__ import annotations

from corpusforge.functions.bytelevel import BYTE_CHARS
from corpusforge.functions.text import CHAT_SPECIALS
from corpusforge.plans.sqlparts import q

# Java's Unicode \s (White_Space), written out for RE2.
WSU = r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\x{01}" + WSU + r"\p{L}\p{N}]+|[" + WSU + "]+"
_RUN = "([" + WSU + "]+)([" + WSU + "][^" + WSU + "])"


def pretokens_sql(expr: str) -> str:
    """T1 without look-ahead: U+0001 is put before the last character of a white
    space run that a non-space follows, and belongs to no token."""
    return f"regexp_extract_all(regexp_replace({expr}, {q(_RUN)}, '\\1' || chr(1) || '\\2', 'g'), {q(_TOKEN)})"


def _symbols_sql(word: str) -> str:
    alphabet = "[" + ", ".join(q(c) for c in BYTE_CHARS) + "]"
    byte = f"CAST('0x' || substr(hex(encode({word})), 2 * i + 1, 2) AS INTEGER)"
    return (f"array_to_string(list_transform(range(0, octet_length(encode({word}))), "
            f"lambda i: chr(2) || {alphabet}[{byte} + 1] || chr(3)), '')")


def _parts(s: str) -> str:
    return f"string_split(substr({s}, 2, length({s}) - 2), chr(3) || chr(2))"


def train_cte(merges: int, texts: list[str], min_frequency: int = 2) -> str:
    """``bpe_merges(rank, l, r)``, ``bpe_ids(token_id, token)`` and
    ``bpe_words(word, ids)`` from the train split (needs split_docs); ``texts``
    are SELECTs of one text column each, to be encoded."""
    extra = "".join(f" UNION ALL SELECT DISTINCT unnest({pretokens_sql('t')}), 0 FROM ({x}) AS x(t)" for x in texts)
    ctes = [f"""bpe_freq AS MATERIALIZED (
      SELECT word, CAST(sum(n) AS BIGINT) AS freq FROM (
        SELECT word, count(*) AS n FROM (SELECT unnest({pretokens_sql('text')}) AS word FROM split_docs
                                         WHERE split = 'train') GROUP BY word{extra}) GROUP BY word),
    bpe_s0 AS MATERIALIZED (SELECT word, freq, {_symbols_sql('word')} AS s FROM bpe_freq)"""]
    for k in range(merges):
        ctes.append(f"""bpe_m{k} AS MATERIALIZED (
      SELECT l, r FROM (SELECT unnest(y[1:len(y) - 1]) AS l, unnest(y[2:]) AS r, freq
                        FROM (SELECT {_parts('s')} AS y, freq FROM bpe_s{k} WHERE freq > 0))
      GROUP BY l, r HAVING sum(freq) >= {min_frequency} ORDER BY sum(freq) DESC, l, r LIMIT 1),
    bpe_s{k + 1} AS MATERIALIZED (
      SELECT word, freq, CASE WHEN m.l IS NULL THEN s ELSE
               replace(s, chr(2) || m.l || chr(3) || chr(2) || m.r || chr(3), chr(2) || m.l || m.r || chr(3)) END AS s
      FROM bpe_s{k} LEFT JOIN bpe_m{k} m ON true)""")
    base = list(CHAT_SPECIALS) + sorted(BYTE_CHARS)
    rows = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(base))
    ctes.append("bpe_merges AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT {k} AS rank, l, r FROM bpe_m{k}" for k in range(merges)) + ")")
    ctes.append(f"""bpe_ids AS MATERIALIZED (
      SELECT * FROM (VALUES {rows}) AS b(token_id, token) UNION ALL
      SELECT CAST({len(base) - 1} + row_number() OVER (ORDER BY first_rank) AS INTEGER), token
      FROM (SELECT l || r AS token, min(rank) AS first_rank FROM bpe_merges GROUP BY 1)),
    bpe_words AS MATERIALIZED (
      SELECT word, list(token_id ORDER BY p) AS ids FROM (
        SELECT word, unnest(y) AS token, unnest(range(0, len(y))) AS p
        FROM (SELECT word, {_parts('s')} AS y FROM bpe_s{merges})) JOIN bpe_ids USING (token) GROUP BY word)""")
    return ",\n    ".join(ctes)


def encode_cte(name: str, src: str, key: str, text: str) -> str:
    """CTE ``name(k, ids)``: ids of one text column per key (needs train_cte)."""
    return f"""{name} AS (
      SELECT s.{key} AS k, coalesce(flatten(list(w.ids ORDER BY x.p) FILTER (WHERE w.ids IS NOT NULL)),
                                    []::INTEGER[]) AS ids
      FROM {src} s
      LEFT JOIN (SELECT {key} AS k, unnest(toks) AS word, unnest(range(0, len(toks))) AS p
                 FROM (SELECT {key}, {pretokens_sql(text)} AS toks FROM {src})) x ON x.k = s.{key}
      LEFT JOIN bpe_words w ON w.word = x.word GROUP BY s.{key})"""


def stream_tokens_cte() -> str:
    """``stream_tokens`` of the framed BPE ids (needs split_docs and train_cte)."""
    return encode_cte("bpe_docs", "split_docs", "doc_id", "text") + """,
    bpe_framed AS (SELECT d.doc_id, d.split, d.order_key, [2] || b.ids || [3] AS ids
                   FROM split_docs d JOIN bpe_docs b ON b.k = d.doc_id),
    bpe_streamed AS (
      SELECT *, CAST(sum(len(ids)) OVER (PARTITION BY split ORDER BY order_key, doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len(ids) AS BIGINT) AS tok_offset,
             CAST(sum(len(ids)) OVER (PARTITION BY split) AS BIGINT) AS tok_total
      FROM bpe_framed),
    stream_tokens AS (SELECT split, tok_offset + unnest(range(0, len(ids))) AS t, unnest(ids) AS tok, tok_total
                      FROM bpe_streamed)"""
