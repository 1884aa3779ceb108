"""Repeated windows of a corpus: which window of ``length`` symbols also
starts earlier (smaller document, or same document and earlier start)?

Shared by the word and byte operators (`substring_dedup`, `suffix_dedup`);
they differ in their symbols and in the ``solve`` step that compares texts.

1. *Anchors.*  In each window the k-gram with the smallest hash (leftmost on
   ties) is its anchor.  That is a function of the window's content, so equal
   windows have equal anchors at equal offsets.  Consecutive windows with one
   anchor occurrence form a *segment*; about 2/(length-k+2) segments per
   symbol, 5 numbers each, leave the map tasks, after equal segments of a
   batch are already folded to the earliest one.
2. *Hot anchors.*  A pass over the texts counts the segments of each of
   65,536 groups of anchors (65,536 numbers, whatever the table).  The anchors
   of a group far above the others are salted by their segment, which keeps
   equal segments together: a passage in a third of all documents, each with
   other words around it, spreads over as many tasks as its rows need.
3. *Exact segments.*  One shuffle on the (salted) anchor; in a sorted stream,
   all but the earliest of equal segments are covered whole.  Anchors that
   occur in only one distinct segment end here (nearly all do), salted ones go
   on.
4. *Text comparison.*  Only distinct segments of anchors with several of them
   fetch their symbols and are compared by ``solve`` (suffix automaton or
   deep-shallow suffix sort), in blocks of at most ``block`` segments, so a
   passage that a third of all documents hold never meets in one task.
   Windows that stay first in a block of a larger or salted group meet once
   more by their 128-bit content hash, which is again a fold to the earliest.

Memory per task is bounded by the Arrow batch, the block and the longest
single text.  Beside the group counts nothing is collected to the driver
or broadcast.  Equality of segments in step 3 is by 128 bits of hash.

Identity of a document is (id, 96 bits of XXH3-128 of its text): repeated identical rows
get identical results and do not cover each other; an id that repeats with
other text counts as another document that starts at the same place in the
order (ties go by that hash).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import as_numpy, group_starts, id_in, mix64, sorted_runs, text_bytes, to_batches, written

SEGMENT = "anchor long, seg long, doc_id long, start long, tag long, meta long"
_SEG_PA = pa.schema([(n, pa.int64()) for n in ("anchor", "seg", "doc_id", "start", "tag", "meta")])
_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd: invertible modulo 2^64
_STRETCH = 1 << 19                             # windows handled at once
_POS_BITS = np.uint64(22)
_LOW32 = 0xFFFFFFFF
_GROUPS = 1 << 16                              # of anchors, for the counts of step 2
_SALTED = 1 << 30                              # flag beside a segment's number of windows
_SALTED_BLOCK = 1 << 32                        # added to block numbers of salted anchors


def _group_of(anchor: np.ndarray) -> np.ndarray:
    return (mix64(anchor ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(48)).astype(np.int64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inv = np.uint64(pow(int(_BASE), -1, 2 ** 64))
    up = np.full(n, _BASE)
    down = np.full(n, inv)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_BYTE_SYMBOLS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_symbols(text: bytes) -> np.ndarray:
    return _BYTE_SYMBOLS[np.frombuffer(text, dtype=np.uint8)]


def word_symbols(text: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` (what bytes.split gives)."""
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(w) for w in text.split()], dtype=np.uint64)


class _Segmenter:
    """Segments of concatenated pieces (no window crosses a piece)."""

    def __init__(self, length: int, k: int):
        self.length, self.k = length, k
        self.up, self.down = _powers(_STRETCH + 4 * length + 8)

    def windows_hash(self, sym: np.ndarray, second: bool = False) -> np.ndarray:
        n = len(sym)
        s = mix64(sym + np.uint64(77)) if second else sym
        p = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(s * self.up[:n], out=p[1:])
        return mix64((p[self.length:] - p[:-self.length]) * self.down[:n - self.length + 1])

    def __call__(self, sym: np.ndarray, ends: np.ndarray):
        """-> (first window, windows, anchor, segment hash); ends: end of each piece."""
        length, k, n = self.length, self.k, len(sym)
        p = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(sym * self.up[:n], out=p[1:])
        kg = mix64((p[k:] - p[:-k]) * self.down[:n - k + 1])
        low = (np.uint64(1) << _POS_BITS) - np.uint64(1)
        m = (kg & ~low) | np.arange(len(kg), dtype=np.uint64)
        span, have = length - k + 1, 1
        while have < span:                                   # sliding minimum by doubling
            step = min(have, span - have)
            m = np.minimum(m[:-step], m[step:])
            have += step
        at = (m & low).astype(np.int64)                      # anchor position of window s
        starts = np.concatenate([[0], ends[:-1]])
        ok = np.zeros(n - length + 2, dtype=np.int8)         # windows inside one piece
        good = ends - starts >= length
        np.add.at(ok, starts[good], 1)
        np.add.at(ok, (ends - length + 1)[good], -1)
        ok = np.cumsum(ok[:-1]) > 0
        new = ok.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
        a = np.flatnonzero(new)
        last = ok.copy()
        last[:-1] &= (at[1:] != at[:-1]) | ~ok[1:]
        b = np.flatnonzero(last)
        seg = mix64((p[b + length] - p[a]) * self.down[a] + (b - a).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        return a, b - a + 1, kg[at[a]], seg


def _stretches(symbols: Iterable[np.ndarray], length: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lists of (document row, offset, symbols) of about _STRETCH symbols."""
    held, n = [], 0
    for row, sym in enumerate(symbols):
        for c in range(0, max(len(sym) - length + 1, 0), _STRETCH):
            part = sym[c:c + _STRETCH + length - 1]
            if held and n + len(part) > _STRETCH + length:
                yield held
                held, n = [], 0
            held.append((row, c, part))
            n += len(part)
    if held:
        yield held


def _merge(doc: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Union of spans; input ordered by (doc, start)."""
    if not len(doc):
        return doc, start, n
    end = start + n
    new = np.ones(len(doc), dtype=bool)
    # running maximum of ends inside a document: shift documents apart
    rank = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]).astype(np.int64)]))
    shift = rank * np.int64(1 << 33)
    reach = np.maximum.accumulate(end + shift)
    new[1:] = (start + shift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    stop = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], start[first], (reach[stop] - shift[stop]) - start[first]


def _segments_of(symbols_of: Callable[[bytes], np.ndarray], length: int, k: int, salts=None):
    """``salts``: None to count the segments per group of anchors, else a
    broadcast array of the number of salts of each group."""
    def run(batches):
        seg_of = _Segmenter(length, k)
        counts = np.zeros(_GROUPS, np.int64)
        for batch in batches:
            texts, ids = text_bytes(batch, "text"), as_numpy(batch, "doc_id")
            tags, more = text_tags(texts)
            order = np.lexsort((more, tags, ids))
            ids, tags, more = ids[order], tags[order], more[order]
            alone = np.ones(len(ids), dtype=bool)      # repeated identical rows are one document
            alone[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (more[1:] != more[:-1])
            shared = (alone[1:] & (ids[1:] == ids[:-1])).any()
            out = []
            for part in _stretches((symbols_of(texts[i] if u else b"") for i, u in zip(order, alone)), length):
                lens = np.array([len(s) for _, _, s in part])
                ends = np.cumsum(lens)
                a, n, anchor, seg = seg_of(np.concatenate([s for _, _, s in part]), ends)
                piece = np.searchsorted(ends, a, side="right")
                rows = np.array([r for r, _, _ in part])
                offs = np.array([c for _, c, _ in part]) - (ends - lens)
                out.append((rows[piece], a + offs[piece], n, anchor, seg))
            if not out:
                continue
            row, start, n, anchor, seg = (np.concatenate(x) for x in zip(*out))
            span = n + length - 1
            # fold equal segments of this batch to the earliest (rows are in order of position)
            place = np.arange(len(row))
            if shared:                                  # documents of one id start at the same place
                place = np.lexsort((more[row], tags[row], start, ids[row]))
            by = place[np.lexsort((seg[place], anchor[place]))]
            first = np.ones(len(by), dtype=bool)
            first[1:] = (anchor[by][1:] != anchor[by][:-1]) | (seg[by][1:] != seg[by][:-1])
            keep = np.sort(by[first])
            group = _group_of(anchor[keep])
            if salts is None:
                counts += np.bincount(group, minlength=_GROUPS)
                continue
            again = np.sort(by[~first])
            anchor, seg, n = anchor[keep], seg[keep], n[keep]
            many = salts.value[group].astype(np.uint64)
            hot = many > 1
            anchor[hot] = mix64(anchor[hot] + (seg[hot] % many[hot] + np.uint64(1)) * _BASE)
            yield from to_batches(_SEG_PA, [
                anchor.view(np.int64), seg.view(np.int64), ids[row[keep]], start[keep], tags[row[keep]],
                (more[row[keep]] << 32) | n | np.where(hot, _SALTED, 0)])
            r, s, m = _merge(row[again], start[again], span[again])
            if len(r):
                yield from to_batches(_SEG_PA, [
                    mix64(ids[r].view(np.uint64) + s.astype(np.uint64)).view(np.int64), np.zeros(len(r), np.int64),
                    ids[r], -1 - s, tags[r], (more[r] << 32) | m])
        if salts is None:
            some = np.flatnonzero(counts)
            yield from to_batches(_COUNT_PA, [some, counts[some]], 1 << 16)
    return run


_COUNT_PA = pa.schema([("g", pa.int64()), ("n", pa.int64())])


def _salts(counted: DataFrame, hot_rows: int) -> np.ndarray:
    """Salts per group of anchors: as many as its rows above the usual need."""
    n = np.zeros(_GROUPS, np.int64)
    for r in counted.groupBy("g").agg(F.sum("n").alias("n")).collect():      # at most _GROUPS rows
        n[r.g] = r.n
    usual = max(hot_rows, 4 * n.mean())
    return np.where(n > usual, np.ceil(n / usual), 1).astype(np.int32)


def _fold(length: int, block: int):
    """Sorted stream (anchor, seg, position): covers of all but the earliest
    of equal segments; what remains of anchors with several distinct segments
    goes on, numbered into blocks, as does all of a salted anchor.  Output
    start < 0: a cover; ``seg``: block."""
    def run(batches):
        prev = None                     # the last row
        count = 0                       # distinct segments of the anchor so far
        pending = None                  # its only first row, not sent on yet
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [as_numpy(batch, c) for c in ("anchor", "seg", "doc_id", "start", "tag", "meta")]
            span = cols[3] < 0
            if span.any():
                yield from to_batches(_SEG_PA, [c[span] for c in cols])
                cols = [c[~span] for c in cols]
            anchor, seg, doc, start, tag, meta = cols
            if not len(anchor):
                continue
            new_a, new_s = np.ones(len(anchor), bool), np.ones(len(anchor), bool)
            new_a[1:] = anchor[1:] != anchor[:-1]
            new_s[1:] = new_a[1:] | (seg[1:] != seg[:-1])
            if prev is not None:
                new_a[0] = anchor[0] != prev[0]
                new_s[0] = new_a[0] or seg[0] != prev[1]
            c = ~new_s
            c[1:] &= (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (tag[1:] != tag[:-1]) | (meta[1:] != meta[:-1])
            c[0] &= prev is None or (doc[0], start[0], tag[0], meta[0]) != prev[2:]      # the same row again covers nothing
            prev = tuple(x[-1] for x in cols)
            salted = (meta & _SALTED) != 0
            meta = meta & ~_SALTED
            if c.any():
                yield from to_batches(_SEG_PA, [anchor[c], np.zeros(c.sum(), np.int64), doc[c], -1 - start[c], tag[c],
                                                (meta[c] & ~_LOW32) | ((meta[c] & _LOW32) + length - 1)])
            f = np.flatnonzero(new_s)
            if not len(f):
                continue
            fa = new_a[f]
            at = np.arange(len(f))
            run_start = np.maximum.accumulate(np.where(fa, at, -1))
            idx = np.where(run_start >= 0, at - run_start, at + count)
            more = np.zeros(len(f), bool)
            more[:-1] = ~fa[1:]
            send = (idx >= 1) | more | salted[f]
            blk = idx // block + np.where(salted[f], _SALTED_BLOCK, 0)
            out = [(anchor[f][send], blk[send], doc[f][send], start[f][send], tag[f][send], meta[f][send])]
            if pending is not None and not fa[0]:
                out.insert(0, tuple(np.array([v]) for v in pending))
            pending = None
            if idx[-1] == 0 and not salted[f[-1]]:
                j = f[-1]
                pending = (anchor[j], 0, doc[j], start[j], tag[j], meta[j])
            count = int(idx[-1]) + 1
            yield from to_batches(_SEG_PA, [np.concatenate(x) for x in zip(*out)])
    return run


def text_tags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The low 64 and the high 32 bits of each text's 128-bit hash."""
    import xxhash

    raw = b"".join(xxhash.xxh3_128_digest(t) for t in texts)
    x = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
    return x[:, 1].view(np.int64) if len(x) else np.zeros(0, np.int64), (x[:, 0] >> np.uint64(32)).astype(np.int64)


def _unpack():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def packed(docs: DataFrame, id_col: str, text_col: str, carry: str | None = None) -> DataFrame:
    """(doc_id, tag, more, blob[, carry]): texts compressed before they are shuffled."""
    cols = [id_in(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]
    src = docs.select(*cols, *([F.col(carry).alias("carry")] if carry else []))

    def run(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = text_bytes(b, "text")
            arrays = [b.column(0), *(pa.array(x, pa.int64()) for x in text_tags(texts)),
                      pa.array([z.compress(t) for t in texts], pa.binary())]
            names = ["doc_id", "tag", "more", "blob"]
            if carry:
                arrays.append(b.column(b.schema.get_field_index("carry")))
                names.append("carry")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, tag long, more long, blob binary"
    if carry:
        schema += f", carry {src.schema['carry'].dataType.simpleString()}"
    return src.mapInArrow(run, schema)


def _pieces(symbols_of, length: int, as_bytes: bool):
    """Cut the listed segments out of their texts."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()),
                        ("more", pa.int64()), ("start", pa.int64()), ("piece", pa.binary())])

    def run(batches):
        dec = _unpack()
        for b in batches:
            out = [[] for _ in schema]
            size = 0
            for doc, tag, more, blob, want in zip(*(b.column(i).to_pylist() for i in range(5))):
                text = dec(blob)
                sym = None if as_bytes else symbols_of(text)
                for w in want:
                    s, e = w["start"], w["start"] + w["n"] + length - 1
                    piece = text[s:e] if as_bytes else sym[s:e].tobytes()
                    for o, v in zip(out, (w["anchor"], w["seg"], doc, tag, more, s, piece)):
                        o.append(v)
                    size += len(piece)
                if size > 8_000_000:
                    yield from to_batches(schema, out)
                    out, size = [[] for _ in schema], 0
            if out[0]:
                yield from to_batches(schema, out)
    return run


def _compare(solve, length: int, k: int, block: int, as_bytes: bool, rows: int):
    """Solve whole (anchor, block) groups.  Windows that stay first in a block
    of a split group go on with their content hash as (anchor, seg)."""
    def run(batches):
        hasher = _Segmenter(length, k)
        for t in sorted_runs(batches, ["anchor", "seg"], rows):
            starts = group_starts(t, ["anchor", "seg"])
            sizes = np.diff(np.append(starts, t.num_rows))
            group = np.repeat(np.arange(len(starts)), sizes)
            doc, tag, more, start, blk = (t.column(c).to_numpy() for c in ("doc_id", "tag", "more", "start", "seg"))
            pieces = t.column("piece").to_pylist()
            order = np.lexsort((more, tag, start, doc))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            covered = solve(group, place, pieces, length)          # per piece: bool per window
            split = (sizes[group] >= block) | (blk > 0)
            cov, firsts = [], []
            for i, hit in enumerate(covered):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                for a, e in zip(edge[::2], edge[1::2]):
                    cov.append((0, 0, doc[i], -1 - (start[i] + a), tag[i], (more[i] << 32) | (e - a + length - 1)))
                if split[i]:
                    sym = byte_symbols(pieces[i]) if as_bytes else np.frombuffer(pieces[i], np.uint64)
                    h1, h2 = hasher.windows_hash(sym), hasher.windows_hash(sym, second=True)
                    for w in np.flatnonzero(~hit):
                        firsts.append((h1[w].view(np.int64), h2[w].view(np.int64), doc[i], start[i] + w, tag[i], (more[i] << 32) | 1))
            for out in (cov, firsts):
                if out:
                    yield from to_batches(_SEG_PA, [np.array(c, dtype=np.int64) for c in zip(*out)])
    return run


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, *, symbols: str, length: int, k: int, solve,
                   block: int = 4096, rows_per_shard: int = 4096, hot_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, tag, more, spans array<struct<start, n>>): symbols to remove.
    Groups of anchors with more than ``hot_rows`` rows (and 4 times the mean)
    are salted."""
    if not 0 < k <= length:
        raise ValueError("need 0 < k <= length")
    as_bytes = symbols == "bytes"
    symbols_of = byte_symbols if as_bytes else word_symbols
    src = docs.select(id_in(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    salts = _salts(src.mapInArrow(_segments_of(symbols_of, length, k), "g long, n long"), hot_rows)
    shared = docs.sparkSession.sparkContext.broadcast(salts)       # _GROUPS numbers
    segs = src.mapInArrow(_segments_of(symbols_of, length, k, shared), SEGMENT)

    def fold(df):
        return (df.repartition("anchor").sortWithinPartitions("anchor", "seg", "doc_id", "start", "tag", "meta")
                .mapInArrow(_fold(length, block), SEGMENT))

    more, n = F.shiftrightunsigned("meta", 32).alias("more"), F.col("meta").bitwiseAND(F.lit(_LOW32)).alias("n")
    t = written(fold(segs), "repeat-segments")
    want = (t.where("start >= 0").select("doc_id", "tag", more, F.struct("anchor", "seg", "start", n).alias("w"))
            .groupBy("doc_id", "tag", "more").agg(F.collect_list("w").alias("want")))
    # a copy of a row must not meet itself: it would cover its own text
    once = packed(docs, id_col, text_col).dropDuplicates(["doc_id", "tag", "more"])
    pieces = (once.join(want, ["doc_id", "tag", "more"]).select("doc_id", "tag", "more", "blob", "want")
              .mapInArrow(_pieces(symbols_of, length, as_bytes),
                          "anchor long, seg long, doc_id long, tag long, more long, start long, piece binary"))
    u = written(pieces.repartition("anchor", "seg").sortWithinPartitions("anchor", "seg")
                .mapInArrow(_compare(solve, length, k, block, as_bytes, rows_per_shard), SEGMENT), "repeat-compared")
    late = fold(u.where("start >= 0")).where("start < 0")
    spans = t.where("start < 0").unionByName(u.where("start < 0")).unionByName(late)
    return (spans.select("doc_id", "tag", more, F.struct((-1 - F.col("start")).alias("start"), n).alias("s"))
            .groupBy("doc_id", "tag", "more").agg(F.collect_set("s").alias("spans")))


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, fn, schema: str,
               carry: str | None = None) -> DataFrame:
    """Join texts with their spans and apply ``fn(text bytes, spans) -> tuple``
    per document; ``schema`` names its values (after doc_id, before carry)."""
    names = [f.split()[0] for f in schema.split(",")]
    joined = packed(docs, id_col, text_col, carry).join(spans, ["doc_id", "tag", "more"], "left")
    keep = ["doc_id", "blob", "spans"] + (["carry"] if carry else [])

    def run(batches):
        dec = _unpack()
        for b in batches:
            rows = [fn(dec(blob), spans or ()) for blob, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            cols = [pa.array(c) for c in zip(*rows)] if rows else None
            if cols is None:
                continue
            arrays, out = [b.column(0), *cols], ["doc_id", *names]
            if carry:
                arrays.append(b.column(3))
                out.append("carry")
            yield pa.RecordBatch.from_arrays(arrays, names=out)

    full = f"doc_id long, {schema}"
    if carry:
        full += f", carry {joined.schema['carry'].dataType.simpleString()}"
    return joined.select(*keep).mapInArrow(run, full)


def removal_mask(n: int, spans) -> np.ndarray:
    step = np.zeros(n + 1, dtype=np.int32)
    for s in spans:
        step[s["start"]] += 1
        step[min(n, s["start"] + s["n"])] -= 1
    return np.cumsum(step[:-1]) > 0
