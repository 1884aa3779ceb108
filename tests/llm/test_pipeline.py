import os
import shutil

from pyspark.sql import functions as F

import corpus_pipeline as P
from corpusforge.llm import packing
from corpusforge.llm.queries import vocabulary
from tests.conftest import SF
from tests.llm.test_simhash import stays


def test_run_with_null_and_repeated_ids(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text is not null")
    i = F.col("doc_id")
    odd = docs.withColumn("doc_id", F.when(i % 3 == 0, F.lit(None)).when(i % 7 == 1, i - i % 14).otherwise(i).cast("long"))
    near = docs.where(i % 5 == 0).withColumn("text", F.concat("text", F.lit(" again"))).withColumn("doc_id", F.lit(None).cast("long"))
    odd.unionByName(near).unionByName(odd.where(i % 11 == 2)).repartition(6).write.parquet(f"{tmp_dir}/documents.parquet")
    for n in ("labels", "benchmark"):
        shutil.copy(os.path.join(SF, f"{n}.parquet"), f"{tmp_dir}/{n}.parquet")
    clean = P.toxicity(spark, spark.read.parquet(f"{tmp_dir}/documents.parquet"), tmp_dir)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    one = stays(rows)
    assert 20 < sum(i == -1 for i, _ in one) and len(one) < len(rows)
    left = spark.createDataFrame([(None if i == -1 else i, t, 0) for i, t in one], "doc_id long, text string, n_chars int")
    left = P.suffix_array_dedup(spark, left, tmp_dir)
    left = P.benchmark_decontamination(spark, left, tmp_dir)

    def placed(df):
        return sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert placed(P.run(spark, tmp_dir)) == placed(packing.pack(left, vocabulary("byte_bpe_50k.json")))


def test_run_on_empty_tables_extra_columns_and_long_texts(spark, tmp_dir):
    columns = "doc_id long, text string, lang string, source string, n_chars int, row string, hits int, tag long, length int"
    long = " ".join(f"word{k % 5000}x{k}" for k in range(60_000))
    rows = [(1, long, "en", "s", len(long), "r", 1, 2, 3), (2, "", "en", "s", 0, None, None, None, None), (3, None, None, None, None, "r", 1, 2, 3),
            (None, "some other text of its own", "de", "t", 26, "r", 1, 2, 3)]
    labels = spark.read.parquet(f"{SF}/labels.parquet").schema
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").schema

    def run(name, docs, with_rows):
        d = f"{tmp_dir}/{name}"
        spark.createDataFrame(docs, columns).write.parquet(f"{d}/documents.parquet")
        for t, schema in (("labels", labels), ("benchmark", bench)):
            src = spark.read.parquet(f"{SF}/{t}.parquet")
            (src if with_rows else src.limit(0)).write.parquet(f"{d}/{t}.parquet")
        return P.run(spark, d).collect()
    assert run("none", [], True) == []
    for with_rows in (False, True):
        out = run(f"some{with_rows}", rows, with_rows)
        kept = {x.doc_id for x in out}
        assert {1, None} <= kept <= {1, 2, 3, None} and len(kept & {2, 3}) == 1        # the empty and the null text are copies
        assert sum(x.length for x in out if x.doc_id == 1) > 60_000
