import json
import os

import pytest
from corpusforge.sources import io, tokenbin


def test_jsonl_failfast_and_required(spark, tmp_dir):
    good = os.path.join(tmp_dir, "good.jsonl")
    with open(good, "w") as f:
        f.write('{"instruction": "a", "response": "b"}\n   \n\n{"instruction": "c", "response": "d"}\n')
    assert io.read_jsonl(spark, good, io.INSTRUCTION_SCHEMA, ["instruction", "response"]).count() == 2
    bad = os.path.join(tmp_dir, "bad.jsonl")
    with open(bad, "w") as f:
        f.write('{"instruction": "a", "response": "b"}\n{"instruction": \n')
    with pytest.raises(Exception):
        io.read_jsonl(spark, bad, io.INSTRUCTION_SCHEMA).collect()
    missing = os.path.join(tmp_dir, "missing.jsonl")
    with open(missing, "w") as f:
        f.write('{"instruction": "a"}\n')
    with pytest.raises(Exception):
        io.read_jsonl(spark, missing, io.INSTRUCTION_SCHEMA, ["instruction", "response"]).collect()


def test_stories_roundtrip(spark, tmp_dir):
    rows = [("one\nline two  ", "train"), ("  three", "validation"), ("four\n\nfive", "train")]
    df = spark.createDataFrame(rows, "text string, split string")
    path = os.path.join(tmp_dir, "stories")
    io.write_stories(df, path)
    back = io.read_stories(spark, path).collect()
    assert sorted(r.text for r in back) == sorted(t.strip() for t, _ in rows)
    train = io.read_stories(spark, os.path.join(path, "split=train")).collect()
    assert sorted(r.text for r in train) == ["four\n\nfive", "one\nline two"]
    raw = "".join(open(os.path.join(path, "split=validation", f), encoding="utf-8").read()
                  for f in os.listdir(os.path.join(path, "split=validation")) if f.endswith(".txt"))
    assert raw == "three\n<|endofstory|>\n"


def test_tokenbin_roundtrip_and_manifest(spark, tmp_dir):
    tokenbin.register(spark)
    rows = [(i, list(range(i * 10, i * 10 + 7))) for i in range(20)]
    df = spark.createDataFrame(rows, "pos long, ids array<int>").repartitionByRange(4, "pos").sortWithinPartitions("pos")
    path = os.path.join(tmp_dir, "bin")
    df.write.format("tokenbin").mode("append").option("path", path).save()
    man = json.load(open(os.path.join(path, "_manifest.json")))
    assert man["n_tokens"] == 140
    back = (spark.read.format("tokenbin").option("path", path).option("chunk_tokens", 16)
            .option("partition_tokens", 32).load())
    flat = [t for r in sorted(back.collect(), key=lambda r: r.offset) for t in r.ids]
    assert flat == [t for _, ids in rows for t in ids]


@pytest.mark.parametrize("L,S", [(8, 0), (8, 3), (5, 9)])
def test_sequences_from_shards_and_pushdown(spark, tmp_dir, L, S):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

    tokenbin.register(spark)
    rows = [(i, list(range(i * 10, i * 10 + i % 7))) for i in range(60)]
    df = spark.createDataFrame(rows, "pos long, ids array<int>").repartitionByRange(4, "pos").sortWithinPartitions("pos")
    path = os.path.join(tmp_dir, "bin")
    df.write.format("tokenbin").mode("append").option("path", path).save()
    flat = [t for _, ids in rows for t in ids]
    n = (len(flat) - L - 1) // (S or L) + 1
    want = {i: flat[i * (S or L):i * (S or L) + L + 1] for i in range(n)}
    seqs = spark.read.format("tokenseq").option("path", path).option("length", L).option("stride", S).option(
        "partition_tokens", 16).load()

    def rows_of(frame):
        return {r.seq_id: [*r.input_ids, r.target_ids[-1]] for r in frame.collect()}
    assert rows_of(seqs) == want
    assert rows_of(seqs.where("seq_id >= 3 and seq_id < 6")) == {i: want[i] for i in (3, 4, 5)}
    assert rows_of(seqs.where("seq_id in (1, 7) and size(input_ids) > 0")) == {i: want[i] for i in (1, 7)}
    assert rows_of(seqs.where("seq_id > 1000000")) == {}
    # a filter reads its own sequences only
    reader = tokenbin.TokenSeqReader({"path": path, "length": L, "stride": S, "partition_tokens": 16})
    some = In(("seq_id",), (1, 7))
    assert list(reader.pushFilters([some, GreaterThanOrEqual(("seq_id",), 1), EqualTo(("other",), 1)])) != []
    assert [(p.first, p.stop) for p in reader.partitions()][0][0] == 1 and max(p.stop for p in reader.partitions()) == 8
    assert list(reader.pushFilters([EqualTo(("seq_id",), 4)])) == []
    assert [(p.first, p.stop) for p in reader.partitions()] == [(4, 5)]
    # and a filter on offset, its byte ranges only
    back = spark.read.format("tokenbin").option("path", path).option("chunk_tokens", 4).option("partition_tokens", 8).load()
    everything = back.collect()
    lo, hi = 20, 61
    assert sorted(back.where(f"offset >= {lo} and offset < {hi}").collect()) == sorted(r for r in everything if lo <= r.offset < hi)
    reader = tokenbin.TokenBinReader({"path": path, "chunk_tokens": 4, "partition_tokens": 8})
    reader.pushFilters([GreaterThanOrEqual(("offset",), lo), LessThan(("offset",), hi)])
    read = sum(p.stop - p.start for p in reader.partitions())
    assert read == sum(len(r.ids) for r in everything if lo <= r.offset < hi)


def test_tokenbin_rejects_wide_ids(spark, tmp_dir):
    tokenbin.register(spark)
    df = spark.createDataFrame([([1, 70000],)], "ids array<int>")
    with pytest.raises(Exception):
        df.write.format("tokenbin").mode("append").option("path", os.path.join(tmp_dir, "w")).save()


def test_manifest_cache_and_report(spark, tmp_dir):
    m = spark.createDataFrame([(32000, 10, 1, 2, 1, 0.25, None)], io.MANIFEST_SCHEMA)
    path = os.path.join(tmp_dir, "meta")
    io.write_manifest(m, path)
    assert io.read_manifest(spark, path).first().train_tokens == 10
    src = os.path.join(tmp_dir, "src.txt")
    with open(src, "w") as f:
        f.write("a\n\n b \n")
    assert [r.text for r in io.read_lines(spark, src).collect()] == ["a", "", "b"]
    k1 = io.cache_key(spark, [src], "tok-v1")
    built = []
    t1 = io.cached_table(spark, os.path.join(tmp_dir, "cache"), k1,
                         lambda: built.append(1) or spark.createDataFrame([(1,)], "x int"))
    t2 = io.cached_table(spark, os.path.join(tmp_dir, "cache"), k1, lambda: built.append(1) or None)
    assert t1.count() == t2.count() == 1 and built == [1]
    with open(src, "a") as f:
        f.write("more\n")
    assert io.cache_key(spark, [src], "tok-v1") != k1
    rep = {r.name: (r.exists, r.n_rows) for r in io.input_report(spark, {"src": src, "nope": src + ".x"}).collect()}
    assert rep == {"src": (True, 4), "nope": (False, 0)}


def test_vocab_tables_roundtrip_and_missing(spark, tmp_dir):
    from corpusforge.operators import bpe
    from corpusforge.functions.bytelevel import to_symbols

    words = spark.createDataFrame([(w, f, list(to_symbols(w))) for w, f in {"abab": 5, "abc": 3}.items()],
                                  "word string, freq long, syms array<string>")
    model = bpe.train_bpe(words, 6 + 256 + 3)
    path = os.path.join(tmp_dir, "tok")
    io.write_vocab(model.vocab_df(spark), model.merges_df(spark), path)
    back = bpe.BpeModel.from_frames(*io.read_vocab(spark, path))
    assert back.token_to_id == model.token_to_id and back.merges == model.merges
    with pytest.raises(FileNotFoundError):
        io.read_vocab(spark, os.path.join(tmp_dir, "absent"))
