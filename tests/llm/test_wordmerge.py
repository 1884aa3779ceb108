import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusforge.llm import pretokens, wordmerge
from corpusforge.llm.queries import op12, vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def texts(n, seed=1):
    r = random.Random(seed)
    alphabet = "ab é ßtheof12 \n\t\r\x0b\x0c\x1c\x1f\xa0 　'.!?-_\x00漢🙂'srevltdm՘\U00011de1"
    return ["".join(r.choices(alphabet, k=r.randrange(0, 80))) for _ in range(n)]


FIXED = ["it's we'll  x", "a  b\n\n c \n", "<|endoftext|> x<|endoftext|><|endoftext|>'s", "   ", "", "a" * 3000, "ab" * 2000,
         " " * 300 + "x", "ἷ" * 100, "''s 'street 're", None]


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("chunk", [300, 2_000_000])
def test_ids_equal_the_library(tok, monkeypatch, chunk):
    monkeypatch.setattr(pretokens, "CHUNK_BYTES", chunk)
    enc, pieces = pretokens.load(PATH, wordmerge.merge_rounds), wordmerge.Pieces(PATH)
    rows = [*texts(4000), *FIXED, "<|endoftext|>" + " word" * 400]
    got, back = [], []
    for _, n, ids, per in enc.encode(pa.array(rows, pa.string())):
        assert len(per) == n
        got += [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])]
        back += pieces.decode(ids.astype(np.int64), per).to_pylist()
    assert got == [e.ids for e in tok.encode_batch([t or "" for t in rows], add_special_tokens=False)]
    assert back == [t or "" for t in rows]


def test_both_ways_to_merge_agree(tok):
    r = random.Random(3)
    m = wordmerge.Merges(PATH)
    words = ["".join(r.choices("thein aab", k=r.randrange(1, 64))).encode() for _ in range(800)] + [b"a" * k for k in range(1, 20)]
    sym = m.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    a, b = m.rounds(sym.copy(), word.copy()), m.by_rank(sym.copy(), word.copy())
    order = np.argsort(a[1], kind="stable")
    assert a[0][order].tolist() == b[0].tolist() and a[1][order].tolist() == b[1].tolist()


def test_very_long_run_and_broken_bytes(tok):
    r = random.Random(4)
    text = "".join(r.choices("abcdefgh", k=200_000))
    enc, pieces = pretokens.load(PATH, wordmerge.merge_rounds), wordmerge.Pieces(PATH)
    (_, _, ids, per), = enc.encode(pa.array([text], pa.string()))
    assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
    cut = np.array([tok.encode("é漢").ids[0], 40, 99_999, 50256], np.int64)       # half a character, an unknown id
    assert pieces.decode(cut, np.array([2, 0, 2])).to_pylist() == [tok.decode(cut[:2].tolist()), "", "<|endoftext|>"]


def test_edge_rows(spark, tok):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, "")]
    df = spark.createDataFrame([(i, t, b"i", 5, "d") for i, t in rows], "doc_id long, text string, ids binary, n_tokens int, decoded string")
    out = wordmerge.decode(wordmerge.encode(df, PATH), PATH).collect()
    got = sorted((x.doc_id or -1, x.n_tokens, x.decoded, np.frombuffer(x.ids, "<u4").tolist()) for x in out)
    want = sorted((i or -1, len(e), t or "", e) for i, t in rows for e in [tok.encode(t or "").ids])
    assert got == want
    assert wordmerge.decode(wordmerge.encode(df.limit(0), PATH), PATH).count() == 0


def test_query_against_the_library(spark, tok):
    d = "/root/testdata/sf0.001"
    got = {x.doc_id: tuple(x)[1:] for x in op12(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                 hashlib.sha256(text.encode()).hexdigest())
