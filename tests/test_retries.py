"""Lost tasks: every task's first attempt fails in the middle of the plan;
the retried job must give exactly the clean result (determinism under
recomputation)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.operators import order
from corpusforge.plans import corpus
from conftest import docs


@F.udf(T.StringType())
def fail_first_attempt(x):
    from pyspark import TaskContext

    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task loss")
    return x


def test_positions_and_packing_survive_task_loss(spark):
    d = docs(spark)
    flaky = d.withColumn("text", fail_first_attempt("text"))
    clean = {r.doc_id: r.pos for r in order.tail_split(d.select("doc_id", "text"), "doc_id").collect()}
    retried = {r.doc_id: r.pos for r in order.tail_split(flaky.select("doc_id", "text"), "doc_id").collect()}
    assert clean == retried

    p = corpus.CorpusParams(vocab_size=512, context_length=64)

    def packed(src):
        toks = corpus.tokenize_documents(corpus.split_documents(src, p), corpus.train_word_vocab(src, p), p)
        return sorted((r.split, r.seq_id, tuple(r.input_ids)) for r in
                      corpus.packed(corpus.streamed_documents(toks), p).collect())

    assert packed(d) == packed(flaky)
