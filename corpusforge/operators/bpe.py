"""Byte-level BPE: pre-tokenise, learn merges, encode, decode.

* T1 is the GPT-2 pattern through ``regexp_extract_all``; T2 and T5 cut whole
  Arrow batches of texts the same way (``functions.cutting``), and T2 counts a
  task's words before ``groupBy(word)`` (so hot words are cheap).
* T3 iterates over the *word table* only, never the corpus, with maintained
  pair counts and batches of merges that equal one merge at a time
  (``bpetrain``).
* T5 splits special tokens out, and applies merges to a batch's distinct words
  at once, in an Arrow UDF with the merge ranks broadcast once (their size is
  bounded by the vocabulary size) and a per-worker cache of words.
  No shuffle: the text stays in its partition.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions import cutting
from corpusforge.functions.bytelevel import BYTE_CHARS, GPT2_PATTERN, LONG_WORD, MergeTable, bpe_segment, from_symbols, to_symbols
from corpusforge.functions.text import BOS_ID, CHAT_SPECIALS, EOS_ID
from corpusforge.operators import bpetrain

#: merge tables up to this many entries are broadcast to the encoder
MAX_BROADCAST_MERGES = 2_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ------------------------------------------------------------------ T1 / T2

def pretokens(col: Column | str, specials: Sequence[str] = (), specials_mode: str = "match") -> Column:
    """Pre-tokens of a text in order.

    ``specials_mode='match'`` (the reference) splits special-token strings out
    first so they survive whole; ``'escape'`` treats them as plain text (user
    text cannot forge a role marker).
    """
    text = _c(col)
    if specials_mode == "escape" or not specials:
        return F.regexp_extract_all(text, F.lit(GPT2_PATTERN), 0)
    if specials_mode != "match":
        raise ValueError(specials_mode)
    alt = "(" + "|".join(re.escape(s) for s in specials) + ")"
    pieces = F.split(text, f"(?={alt})|(?<={alt})")  # zero-width: no character of the text is consumed
    spec = F.array(*[F.lit(s) for s in specials])
    per_piece = F.transform(pieces, lambda p: F.when(F.array_contains(spec, p), F.array(p)).otherwise(
        F.regexp_extract_all(p, F.lit(GPT2_PATTERN), 0)))
    return F.flatten(per_piece)


def to_symbol_array(word: Column | str) -> Column:
    """Byte-alphabet characters of a word's UTF-8 bytes, as ``array<string>``."""
    as_bytes = F.decode(F.encode(_c(word), "UTF-8"), "ISO-8859-1")  # one character a byte
    moved = [b for b in range(256) if BYTE_CHARS[b] != chr(b)]
    return F.split(F.translate(as_bytes, "".join(map(chr, moved)), "".join(BYTE_CHARS[b] for b in moved)), "")


#: a task holds up to about so many counted words before it passes them on
_HELD_WORDS = 500_000


def pretoken_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, freq, syms`` over the whole input.

    Texts are cut and words counted in Arrow, so that Spark gets a task's
    distinct words, some hundred thousand at a time, instead of all its words."""
    classes = cutting.char_classes(df.sparkSession)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def summed(held):
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        held, rows = [], 0
        for b in batches:
            for toks in cutting.cut_texts(b.column(0), classes):
                counts = pc.value_counts(pc.list_flatten(toks))
                held.append(pa.table([counts.field("values"), counts.field("counts")], names=["word", "n"]))
                rows += len(counts)
                if rows > _HELD_WORDS:
                    held = [summed(held)]
                    rows = len(held[0])
                    if rows > _HELD_WORDS // 2:
                        yield from held[0].to_batches(max_chunksize=50_000)
                        held, rows = [], 0
        if held:
            yield from summed(held).to_batches(max_chunksize=50_000)

    counts = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("freq")).withColumn("syms", to_symbol_array("word"))


# ----------------------------------------------------------------------- T3

@dataclass
class BpeModel:
    specials: list[str]
    alphabet: list[str]
    merges: list[tuple[str, str]]
    rounds: int = 0
    token_to_id: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        if not self.token_to_id:
            toks = list(self.specials) + list(self.alphabet) + [a + b for a, b in self.merges]
            self.token_to_id = {}
            for t in toks:
                self.token_to_id.setdefault(t, len(self.token_to_id))

    @property
    def vocab_size(self) -> int:
        return len(self.token_to_id)

    def ranks(self) -> dict[tuple[str, str], int]:
        return {m: i for i, m in enumerate(self.merges)}

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        sp = set(self.specials)
        rows = [(i, t, "special" if t in sp else "token") for t, i in self.token_to_id.items()]
        return spark.createDataFrame(rows, "token_id int, token string, kind string")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(self.merges)],
                                     "rank int, left string, right string")

    @classmethod
    def from_frames(cls, vocab: DataFrame, merges: DataFrame) -> "BpeModel":
        """Rebuild from the two tables (bounded by the vocabulary size)."""
        v = sorted(vocab.collect(), key=lambda r: r["token_id"])
        m = sorted(merges.collect(), key=lambda r: r["rank"])
        specials = [r["token"] for r in v if r["kind"] == "special"]
        merged = {r["left"] + r["right"] for r in m}
        alphabet = [r["token"] for r in v if r["kind"] != "special" and r["token"] not in merged]
        return cls(specials, alphabet, [(r["left"], r["right"]) for r in m],
                   token_to_id={r["token"]: r["token_id"] for r in v})


def train_bpe(words: DataFrame, vocab_size: int, min_frequency: int = 2,
              specials: Sequence[str] = CHAT_SPECIALS, mode: str = "exact", fast_k: int = 32,
              full_byte_alphabet: bool = True, checkpoint_every: int = 5,
              max_rounds: int | None = None, tracked_pairs: int = bpetrain.TRACKED) -> BpeModel:
    """Learn merges from a ``word, freq, syms`` table until the vocabulary
    holds ``vocab_size`` entries or no pair reaches ``min_frequency``.

    ``full_byte_alphabet`` puts all 256 byte symbols in the vocabulary (lossless
    encoding); ``False`` keeps only symbols seen in training, as the reference
    does, so unseen bytes vanish at encode time.  ``mode="fast"`` merges all
    pairs without a common symbol among the first ``fast_k`` (another, slightly
    different vocabulary); exact training rarely needs more rounds.
    """
    if full_byte_alphabet:
        alphabet = sorted(BYTE_CHARS)
    else:                                  # at most 256 symbols
        alphabet = sorted(r[0] for r in words.select(F.explode("syms")).distinct().collect())
    symbols = set(specials) | set(alphabet)
    merges, rounds = bpetrain.learn_merges(words, alphabet, symbols, vocab_size - len(symbols), min_frequency, mode, fast_k,
                                           checkpoint_every, max_rounds, tracked_pairs)
    return BpeModel(list(specials), alphabet, merges, rounds)


# ------------------------------------------------------------------ T5 / T7

_CACHES: dict[str, dict[bytes, bytes]] = {}
#: words kept by a worker and model, pre-tokens encoded and symbols of words merged at once: they bound a worker's memory
_CACHE_LIMIT = 200_000
_SLICE = 500_000
_SYMBOLS = 200_000
#: up to so many distinct words are looked up in the cache one by one
_FEW_WORDS = 2_000
#: ids decoded at once
_DECODED = 2_000_000
#: merge tables of a worker, by the ranks they were made from
_MERGES: dict[int, tuple[dict, MergeTable]] = {}


def _broadcast_model(spark: SparkSession, model: BpeModel):
    if len(model.merges) > MAX_BROADCAST_MERGES:
        raise ValueError("merge table too large to broadcast; raise MAX_BROADCAST_MERGES knowingly")
    return spark.sparkContext.broadcast((model.token_to_id, model.ranks(),
                                         {s: model.token_to_id[s] for s in model.specials}))


def _encode_lists(toks, t2i: dict, ranks: dict, specials: dict, cache: dict):
    """Encode one Arrow batch of ``list<string>`` pre-tokens, some rows at a time."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(toks, pa.ChunkedArray):
        toks = toks.combine_chunks()
    ends = np.cumsum(pc.list_value_length(toks).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, at = [], 0
    while at < len(toks):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + _SLICE, "right")))
        if len(cache) > _CACHE_LIMIT:
            cache.clear()
        out.append(_encode_rows(toks.slice(at, stop - at), t2i, ranks, specials, cache))
        at = stop
    return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))


def _merge_table(ranks: dict) -> MergeTable:
    if id(ranks) not in _MERGES or _MERGES[id(ranks)][0] is not ranks:
        if len(_MERGES) > 7:
            _MERGES.clear()
        _MERGES[id(ranks)] = ranks, MergeTable(ranks)
    return _MERGES[id(ranks)][1]


def _segment(words: list[bytes], t2i: dict, ranks: dict, cache: dict):
    """Put the ids of words into ``cache``; short words are segmented all at once."""
    import numpy as np

    for w in words:
        if len(w) > LONG_WORD:
            ids = [t2i[p] for p in bpe_segment(to_symbols(w.decode("utf-8")), ranks) if p in t2i]
            cache[w] = np.array(ids, np.int32).tobytes()
    short = [w for w in words if len(w) <= LONG_WORD]
    if not short:
        return
    table = _merge_table(ranks)
    syms, size = table.segment(short)
    ids = np.array([t2i.get(s, -1) for s in table.names], np.int32)[syms]
    kept = ids >= 0
    ends = (np.concatenate([[0], np.cumsum(kept)])[np.cumsum(size)] * ids.itemsize).tolist()
    ids = ids[kept].tobytes()
    cache.update(zip(short, map(ids.__getitem__, map(slice, [0, *ends], ends))))


def _cached_ids(words, t2i: dict, ranks: dict, specials: dict, cache: dict):
    """The ids of each word of an Arrow array, as the bytes of their integers."""
    import numpy as np
    import pyarrow as pa

    words = words.cast(pa.binary()).to_pylist()
    new = [w for w in words if w not in cache]
    whole = {s.encode("utf-8"): np.int32(i).tobytes() for s, i in specials.items()}
    cache.update((w, whole[w]) for w in new if w in whole)
    _segment([w for w in new if w not in whole], t2i, ranks, cache)
    return pa.array([cache[w] for w in words], pa.large_binary())


def _word_ids(words, t2i: dict, ranks: dict, specials: dict, cache: dict):
    """``_cached_ids`` of many words: short ones are segmented out of the array's
    own buffer and not cached, as most of them are rare."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    table = _merge_table(ranks)
    number = np.array([t2i.get(s, -1) for s in table.names], np.int32)
    at = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    size = np.diff(at).astype(np.int64)
    odd = size > LONG_WORD
    for s in specials:
        if (found := pc.index(words, s).as_py()) >= 0:
            odd[found] = True
    if odd.any():
        data, size = data[np.repeat(~odd, size)], np.where(odd, 0, size)
    ends = np.concatenate([[0], np.cumsum(size)])
    ids, lens, done = [], [], 0
    while done < len(size):
        stop = max(done + 1, int(np.searchsorted(ends, ends[done] + _SYMBOLS, "right")) - 1)
        syms, made = table.segment_bytes(data[ends[done]:ends[stop]], size[done:stop])
        got = number[syms]
        kept = got >= 0
        if not kept.all():
            made = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(made)])])
            got = got[kept]
        ids.append(got)
        lens.append(made)
        done = stop
    ids, lens = np.concatenate(ids), np.concatenate(lens)
    if odd.any():
        more = _cached_ids(words.filter(pa.array(odd)), t2i, ranks, specials, cache)
        lens[odd] = pc.binary_length(more).to_numpy() // ids.itemsize
        here, short = np.repeat(odd, lens), ids
        ids = np.empty(len(here), np.int32)
        ids[~here] = short
        ids[here] = np.frombuffer(more.buffers()[2] or b"", np.int32, int(lens[odd].sum()))
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64) * ids.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _encode_rows(toks, t2i: dict, ranks: dict, specials: dict, cache: dict):
    """Words are dictionary-encoded in Arrow, each *distinct* word is segmented
    once, and every row's ids are the taken bytes of its words; the result is
    built from offsets, with no per-row Python."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lens = pc.list_value_length(toks).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(toks)
    if len(flat) == 0:
        offsets = np.zeros(len(lens) + 1, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array([], pa.int32()), mask=pc.is_null(toks))
    enc = pc.dictionary_encode(flat)
    words = enc.dictionary.cast(pa.string())
    segs = (_cached_ids if len(words) <= _FEW_WORDS else _word_ids)(words, t2i, ranks, specials, cache)
    occ = pc.take(segs, enc.indices)                      # the ids of all occurrences, one after the other
    occ_end = np.frombuffer(occ.buffers()[1], np.int64)[occ.offset:occ.offset + len(occ) + 1]
    ids = np.frombuffer(occ.buffers()[2] or b"", np.int32, int(occ_end[-1]) // 4)
    offsets = np.concatenate([[0], occ_end[np.cumsum(lens)] // ids.itemsize]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=pc.is_null(toks))


def _encoder(spark: SparkSession, model: BpeModel, specials_mode: str):
    """A function of an Arrow array of texts: their ids, some texts at a time."""
    bc = _broadcast_model(spark, model)
    key = hashlib.md5(repr((sorted(model.token_to_id.items()), model.merges, specials_mode)).encode()).hexdigest()
    specials = list(model.specials) if specials_mode == "match" else []
    classes = cutting.char_classes(spark)

    def encoded(texts):
        t2i, ranks, sp = bc.value
        cache = _CACHES.setdefault(key, {})  # lives as long as the worker keeps this function
        for toks in cutting.cut_texts(texts, classes, specials):
            yield _encode_lists(toks, t2i, ranks, sp if specials else {}, cache)
    return encoded


def encode_column(spark: SparkSession, model: BpeModel, specials_mode: str = "match"):
    """T5: a Column function ``text -> array<int>`` (no framing)."""
    encoded = _encoder(spark, model, specials_mode)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _ids(texts):
        import pyarrow as pa

        out = list(encoded(texts))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return lambda text: _ids(_c(text).cast("string"))


def token_count_column(spark: SparkSession, model: BpeModel, specials_mode: str = "match"):
    """T5: a Column function ``text -> int``, the number of ids.  A worker holds
    the ids of some texts at a time, and none of them leaves it."""
    encoded = _encoder(spark, model, specials_mode)

    @F.arrow_udf(T.IntegerType())
    def _size(texts):
        import pyarrow as pa
        import pyarrow.compute as pc

        out = [pc.list_value_length(ids) for ids in encoded(texts)]
        return pa.concat_arrays(out) if out else pa.array([], pa.int32())

    return lambda text: _size(_c(text).cast("string"))


def decode_column(spark: SparkSession, model: BpeModel, skip_special: bool = True):
    """A Column function ``array<int> -> string`` (specials skipped)."""
    size = max(model.token_to_id.values()) + 1
    table: list[bytes] = [b""] * size
    sp = set(model.specials)
    for t, i in model.token_to_id.items():
        table[i] = b"" if (t in sp and skip_special) else (t.encode("utf-8") if t in sp else from_symbols(t))
    bc = spark.sparkContext.broadcast(table)

    @F.arrow_udf(T.StringType())
    def _text(id_lists):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(id_lists, pa.ChunkedArray):
            id_lists = id_lists.combine_chunks()
        pieces, out, at = pa.array(bc.value, pa.binary()), [], 0
        ends = id_lists.offsets.to_numpy(zero_copy_only=False)
        while at < len(id_lists):
            stop = max(at + 1, int(np.searchsorted(ends, int(ends[at]) + _DECODED, "right")) - 1)
            part = id_lists.slice(at, stop - at)
            off = pc.subtract(part.offsets, part.offsets[0])
            parts = pa.ListArray.from_arrays(off, pc.take(pieces, pc.list_flatten(part)), mask=pc.is_null(part))
            joined = pc.binary_join(parts, b"")
            try:
                out.append(joined.cast(pa.string()))
            except pa.ArrowInvalid:               # ids that cut a character
                out.append(pa.array([None if b is None else b.decode("utf-8", errors="replace") for b in joined.to_pylist()], pa.string()))
            at = stop
        return pa.concat_arrays(out) if out else pa.array([], pa.string())

    return _text


def frame(ids: Column | str, bos: int = BOS_ID, eos: int = EOS_ID, double: bool = False) -> Column:
    """``[bos] + ids + [eos]`` (``double`` = the reference's ``bos bos .. eos eos``)."""
    n = 2 if double else 1
    return F.concat(F.array(*[F.lit(bos)] * n), _c(ids), F.array(*[F.lit(eos)] * n))


# ----------------------------------------------------------------- T8 / T9

def tokenizer_report(encoded: DataFrame, vocab: DataFrame, vocab_size: int, top_n: int = 20,
                     text_col: str = "text", ids_col: str = "ids",
                     chars_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Characters per token, distinct ids, coverage (distinct / vocab)
    and the ``top_n`` most frequent ids with their tokens.  ``chars_col``
    holds text lengths where the texts themselves are not carried."""
    chars = F.col(chars_col) if chars_col else F.length(text_col)
    summary = encoded.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(chars).cast("long").alias("n_chars"),
        F.sum(F.size(ids_col)).cast("long").alias("n_tokens"))
    distinct = encoded.select(F.explode(ids_col).alias("token_id")).agg(
        F.countDistinct("token_id").alias("distinct_ids"))
    summary = summary.select(
        "n_texts", "n_chars", "n_tokens",
        F.round(F.col("n_chars") / F.col("n_tokens"), 6).alias("chars_per_token"),
        distinct.scalar().alias("distinct_ids"),
    ).withColumn("coverage_pct", F.round(F.col("distinct_ids") * 100.0 / vocab_size, 6))
    counts = encoded.select(F.explode(ids_col).alias("token_id")).groupBy("token_id").agg(
        F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col("token_id").asc()).limit(top_n)
    top = top.join(vocab.select("token_id", "token"), on="token_id", how="left")
    return summary, top


def example_report(texts: DataFrame, encode, vocab: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Ids, tokens and length per example text.  Token strings come from
    an equi-join with the vocabulary (broadcast if it is small) and are
    re-assembled in position order per ``key``."""
    d = texts.select(key, text_col, encode(text_col).alias("ids"))
    ex = d.select(key, F.posexplode("ids").alias("p", "token_id"))
    toks = ex.join(vocab.select("token_id", "token"), on="token_id", how="left")
    g = toks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("p", "token"))).alias("_t"))
    return d.join(g, on=key, how="left").select(
        key, text_col, "ids", F.coalesce(F.transform("_t", lambda s: s["token"]), F.array().cast("array<string>"))
        .alias("tokens"), F.size("ids").alias("n_tokens"))
