"""Pre-tokens of many texts at once, cut as ``GPT2_PATTERN`` cuts them.

A pre-token of the pattern is a run of letters, of numbers or of other
characters, with the space before it, or a run of white space; an apostrophe
may take ``s t re ve m ll d`` from the letters after it.  So the characters'
classes state all borders, and an Arrow batch of texts is cut by a few numpy
passes over its bytes: the pre-tokens are slices of the texts' own buffer.

The classes come from the JVM's regex engine, once per session: the cut is the
one of the column function ``bpe.pretokens`` whatever Unicode version Python has.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np

OTHER, LETTER, NUMBER, SPACE = b"!a0 "
#: texts of about so many bytes are cut at once
CUT_BYTES = 4 << 20
_BLOCK = 4096
_CLASSES: dict[str, bytes] = {}
_TABLES: dict[bytes, np.ndarray] = {}


def char_classes(spark) -> bytes:
    """The class of every code point, one byte each, compressed (a few kilobytes)."""
    from pyspark.sql import functions as F

    key = spark.sparkContext.applicationId
    if key not in _CLASSES:
        # surrogates are no characters of a text
        rows = [(i, "".join(map(chr, range(i, i + _BLOCK)))) for i in [*range(0, 0xD000, _BLOCK), *range(0xE000, 0x110000, _BLOCK)]]
        rows.append((0xD000, "".join(map(chr, range(0xD000, 0xD800)))))
        kind = F.col("chars")
        for pattern, mark in ((r"[^\s\p{L}\p{N}]", OTHER), (r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
            kind = F.regexp_replace(kind, "(?U)" + pattern, chr(mark))
        table = np.full(0x110000, OTHER, np.uint8)
        for at, marks in spark.createDataFrame(rows, "at int, chars string").select("at", kind).collect():
            table[at:at + len(marks)] = np.frombuffer(marks.encode("ascii"), np.uint8)
        _CLASSES[key] = zlib.compress(table.tobytes())
    return _CLASSES[key]


def _table(classes: bytes) -> np.ndarray:
    if classes not in _TABLES:
        _TABLES[classes] = np.frombuffer(zlib.decompress(classes), np.uint8)
    return _TABLES[classes]


def _kinds(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """The class of every byte of UTF-8 bytes, that of its character, and where
    characters go on (None: nowhere)."""
    kind = np.frombuffer(data.tobytes().translate(table[:256].tobytes()), np.uint8)
    if data.max(initial=0) < 0x80:
        return kind, None
    kind = kind.copy()
    at = np.flatnonzero(data >= 0xC0)
    code = data[at].astype(np.int32)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for least, below, size, bits in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
        some = np.flatnonzero((data[at] >= least) & (data[at] < below))
        value = code[some] & bits
        for i in range(1, size):
            value = value << 6 | (padded[at[some] + i] & 0x3F)
        code[some] = np.minimum(value, 0x10FFFF)
    kind[at] = table[code]
    inside = (data & 0xC0) == 0x80
    rest = np.flatnonzero(inside)
    kind[rest] = kind[_character(rest, inside)]
    return kind, inside


def _character(at: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """The first bytes of the characters that lie at some places."""
    while (back := inside[at] & (at > 0)).any():
        at = at - back
    return at


def token_starts(data: np.ndarray, breaks: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pre-tokens of UTF-8 bytes begin; the pattern sees
    the bytes between two ``breaks`` (ascending offsets) as a text of its own.
    All bytes of a character have its class, so no border falls inside one."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int32)
    kind, inside = _kinds(data, table)
    first = np.zeros(n + 1, bool)
    first[breaks] = True
    first[0] = first[n] = True
    begin = first.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begin)              # ends with n
    size, begin = np.diff(runs), begin[:n]
    kinds = kind[runs[:-1]]
    # white space before something: its last character stands alone, a blank goes with what follows
    before = np.flatnonzero((kinds == SPACE) & ~first[runs[1:]])
    last = runs[before + 1] - 1
    if inside is not None:
        last = _character(last, inside)
    begin[last] = True
    begin[last[data[last] == 0x20] + 1] = False
    # an apostrophe that begins a pre-token and the letters it takes
    quote = np.flatnonzero((data[runs[:-1]] == 0x27) & (size == 1) & ~first[runs[1:]] & begin[runs[:-1]])
    quote = quote[kinds[np.minimum(quote + 1, len(kinds) - 1)] == LETTER]
    start, length = runs[quote + 1], size[quote + 1]
    one = data[start]
    two = np.where(length > 1, data[np.minimum(start + 1, n - 1)], 0)
    takes = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for a, b in ("re", "ve", "ll"):
        takes[(one == ord(a)) & (two == ord(b))] = 2
    begin[start[takes > 0]] = False
    longer = (takes > 0) & (length > takes)
    begin[(start + takes)[longer]] = True
    return np.flatnonzero(begin).astype(np.int32)


def _breaks(texts, ends: np.ndarray, specials: Sequence[str]) -> tuple[list[int], list[tuple[int, int]]]:
    """Offsets at which special strings begin or end, and the specials' (start, end)."""
    import pyarrow.compute as pc

    alt = "|".join(re.escape(s) for s in specials)
    cut = re.compile("(?=" + alt + ")|" + "|".join(f"(?<={re.escape(s)})" for s in specials))
    hold = np.zeros(len(texts), bool)
    for s in specials:
        hold |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
    breaks, whole, names = [], [], set(specials)
    for i in np.flatnonzero(hold).tolist():
        place = int(ends[i])
        for piece in cut.split(texts[i].as_py()):
            size = len(piece.encode("utf-8"))
            breaks.append(place)
            if piece in names:
                whole.append((place, place + size))
            place += size
    return breaks, whole


def cut_texts(texts, classes: bytes, specials: Sequence[str] = ()) -> Iterator:
    """Slices of an Arrow array of texts, each as a ``list<string>`` array of pre-tokens."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    table = _table(classes)
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (int(sizes[at - 1]) if at else 0) + CUT_BYTES, "right")))
        part = texts.slice(at, stop - at)
        null, part = pc.is_null(part), pa.concat_arrays([part.fill_null("").cast(pa.string())])
        _, ends, data = part.buffers()
        ends = np.frombuffer(ends, np.int32)[part.offset:part.offset + len(part) + 1]
        base = int(ends[0])
        text = np.frombuffer(data, np.uint8)[base:int(ends[-1])] if data is not None else np.zeros(0, np.uint8)
        ends = ends - base
        held = text.tobytes() if specials else b""
        some = any(s.encode("utf-8") in held for s in specials)
        more, whole = _breaks(part, ends, specials) if some else ([], [])
        starts = token_starts(text, np.union1d(ends, np.array(more, np.int32)) if more else ends, table)
        if whole:
            spans = np.array(whole, np.int32)
            starts = starts[np.searchsorted(spans[:, 0], starts, "left") <= np.searchsorted(spans[:, 1], starts, "right")]
        tokens = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(text)).astype(np.int32)), pa.py_buffer(text))
        rows = np.searchsorted(starts, ends).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(rows), tokens, mask=null)
        at = stop
