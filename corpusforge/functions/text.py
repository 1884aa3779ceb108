"""Column expressions for text cleaning, templating and reply parsing.

All of these are built-in Spark SQL expressions: they stay inside
whole-stage codegen and push no row through Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.isspace() accepts, written as a
# regex class body that both Java regex and RE2 (DuckDB) read identically.
WS_CLASS = (
    r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
STRIP_PATTERN = rf"\A[{WS_CLASS}]+|[{WS_CLASS}]+\z"
NON_WS_PATTERN = rf"[^{WS_CLASS}]"

# Special token strings and ids of the chat vocabulary.
PAD, UNK, BOS, EOS, USER, ASSISTANT = (
    "<|pad|>", "<|unk|>", "<|bos|>", "<|eos|>", "<|user|>", "<|assistant|>")
ENDOFSTORY = "<|endofstory|>"
STORY_SEPARATOR = "\n<|endofstory|>\n"
CHAT_SPECIALS = [PAD, UNK, BOS, EOS, USER, ASSISTANT]
STORY_SPECIALS = [PAD, UNK, BOS, EOS, ENDOFSTORY]
PAD_ID, UNK_ID, BOS_ID, EOS_ID, USER_ID, ASSISTANT_ID = 0, 1, 2, 3, 4, 5
IGNORE_INDEX = -100


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (Python ``str.strip()``)."""
    return F.regexp_replace(_c(col), STRIP_PATTERN, "")


def is_blank(col: Column | str) -> Column:
    """True when nothing but whitespace remains after P1 (nulls count as blank)."""
    return F.coalesce(~_c(col).rlike(NON_WS_PATTERN), F.lit(True))


def non_blank(col: Column | str) -> Column:
    """P2 predicate: keep rows whose stripped text is non-empty."""
    return ~is_blank(col)


def prefix(col: Column | str, n: int) -> Column:
    """First ``n`` code points."""
    return F.left(_c(col), F.lit(n))


def bullet_list(arr: Column | str, bullet: str = "- ") -> Column:
    """P4 helper: ``'\\n'.join(f'- {x}' for x in arr)``."""
    return F.array_join(F.transform(_c(arr), lambda x: F.concat(F.lit(bullet), x)), "\n")


def fill_template(template: str, **fields: Column) -> Column:
    """Substitute ``{name}`` placeholders with column values.

    The template is split at placeholders on the driver, so the result is one
    ``concat`` of literals and columns.
    """
    import re

    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(fields[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def strip_wrapping_quotes(col: Column | str) -> Column:
    """P5: strip, then drop one pair of ``"`` when both ends carry one.

    A lone ``"`` starts and ends with a quote, so it becomes empty.
    """
    s = strip(col)
    inner = F.substring(s, F.lit(2), F.greatest(F.length(s) - 2, F.lit(0)))
    return F.when(s.startswith('"') & s.endswith('"'), inner).otherwise(s)


def fenced_payload(col: Column | str) -> Column:
    """If the stripped reply starts with a code fence, keep the text
    between the first two fences, drop a leading ``json`` and strip."""
    s = strip(col)
    piece = F.coalesce(F.get(F.split(s, "```"), 1), F.lit(""))
    piece = F.when(piece.startswith("json"), F.substring(piece, 5, 1 << 30)).otherwise(piece)
    return F.when(s.startswith("```"), strip(piece)).otherwise(s)


def json_keys(col: Column | str) -> Column:
    """P7 helper: top-level keys of a JSON object; NULL when malformed."""
    return F.json_object_keys(_c(col))


def has_keys(col: Column | str, keys: Sequence[str]) -> Column:
    """The JSON text parses as an object holding every key (values may be null)."""
    k = json_keys(col)
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.array_contains(k, F.lit(key))
    return F.coalesce(cond, F.lit(False))


def parse_object(col: Column | str, fields: Sequence[str]) -> Column:
    """Parse a reply into a struct of string fields (NULL fields when absent)."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return F.from_json(_c(col), schema)


def scrub_tokens(col: Column | str, tokens: Sequence[str] = (EOS, PAD),
                 lstrip_chars: str | None = None) -> Column:
    """Literal removal of special-token strings, then strip, then an
    optional left-trim of a character set (e.g. ``".,;:!?"``)."""
    out = _c(col)
    for tok in tokens:
        out = F.replace(out, F.lit(tok), F.lit(""))
    out = strip(out)
    if lstrip_chars:
        out = F.ltrim(out, F.lit(lstrip_chars))
    return out


def chat_text(prompt: Column | str, response: Column | str | None = None,
              mode: str = "chat") -> Column:
    """``<bos><user>{p}<assistant>`` (chat), ``<bos>{p}`` (base), plus
    ``{response}<eos>`` when a response is given."""
    if mode == "chat":
        head = F.concat(F.lit(BOS + USER), _c(prompt), F.lit(ASSISTANT))
    elif mode == "base":
        head = F.concat(F.lit(BOS), _c(prompt))
    else:
        raise ValueError(f"unknown chat mode {mode!r}")
    if response is None:
        return head
    return F.concat(head, _c(response), F.lit(EOS))


def parse_verdict(col: Column | str) -> Column:
    """P10: ``'A'``/``'B'`` after strip + upper, else NULL (unparsed)."""
    v = F.upper(strip(col))
    return F.when(v.isin("A", "B"), v)


def preference_columns(verdict: Column | str, a: Column | str, b: Column | str) -> list[Column]:
    """(chosen, rejected) from a verdict and the two responses."""
    v, ca, cb = _c(verdict), _c(a), _c(b)
    chosen = F.when(v == "A", ca).when(v == "B", cb)
    rejected = F.when(v == "A", cb).when(v == "B", ca)
    return [chosen.alias("chosen"), rejected.alias("rejected")]


def valid_pair(a: Column | str, b: Column | str) -> Column:
    """Both responses non-blank and not exactly equal."""
    return non_blank(a) & non_blank(b) & (_c(a) != _c(b))


def please_lower(col: Column | str) -> Column:
    """``"Please " + base.lower()``."""
    return F.concat(F.lit("Please "), F.lower(_c(col)))


def seeded_hash_mod(n: int, seed: int, *cols: Column | str, salt: str = "") -> Column:
    """Deterministic uniform choice in ``[0, n)`` from md5 of (seed, salt, cols).

    md5 is used (not Spark's own hash) so that DuckDB can reproduce it.
    """
    parts = [F.lit(str(seed))] + ([F.lit(salt)] if salt else []) + [_c(c).cast("string") for c in cols]
    h = F.md5(F.concat_ws(":", *parts))
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("long"), F.lit(n))
