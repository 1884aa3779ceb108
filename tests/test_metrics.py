import math

from pyspark.sql import functions as F

from corpusforge.operators import metrics as Mx


def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, example_id long, side string, pos int, label int, logp double")


def test_logprob_zero_when_nothing_scored_and_dpo_extremes(spark):
    rows = []
    # example 1: z = 0 exactly; example 2: huge positive margin; example 3: huge negative
    for ex, (pc, pr) in {1: (-1.0, -1.0), 2: (0.0, -10000.0), 3: (-10000.0, 0.0)}.items():
        rows += [("policy", ex, "chosen", 0, 5, pc), ("policy", ex, "rejected", 0, 5, pr),
                 ("reference", ex, "chosen", 0, 5, 0.0), ("reference", ex, "rejected", 0, 5, 0.0)]
    rows.append(("policy", 4, "chosen", 0, -100, -3.0))
    seq = Mx.sequence_logprob(scored(spark, rows))
    s4 = seq.where("example_id = 4").first()
    assert s4.seq_logp == 0.0 and s4.n_scored == 0
    per = {r.example_id: r for r in Mx.dpo_example_metrics(seq.where("example_id < 4"), beta=0.1).collect()}
    assert per[1].correct == 0.0 and abs(per[1].loss - math.log(2)) < 1e-12
    assert per[2].loss == 0.0 and per[2].correct == 1.0
    assert abs(per[3].loss - 1000.0) < 1e-9 and math.isfinite(per[3].loss)


def test_masked_ce_and_epoch_means(spark):
    t = spark.createDataFrame([(0, 2.0, 1.0), (0, 4.0, 1.0), (1, 9.0, 0.0)], "batch_id long, ce double, mask double")
    got = {r.batch_id: r.masked_ce for r in Mx.masked_mean_ce(t, ["batch_id"]).collect()}
    assert got[0] == 6.0 / (2.0 + 1e-8) and got[1] == 0.0
    b = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0), (0, 1, 10.0)], "epoch int, batch_id long, loss double")
    e = Mx.epoch_metric(b, ["epoch"]).first()
    assert e.mean_of_batch_means == 6.0 and abs(e.row_weighted_mean - 14.0 / 3) < 1e-12


def test_best_epoch_first_of_equals(spark):
    e = spark.createDataFrame([(1, 0, 3.0), (1, 1, 2.0), (1, 2, 2.0), (1, 3, 2.5)], "run int, epoch int, val_loss double")
    b = Mx.best_epoch(e).first()
    assert b.best_epoch == 1
    flags = {r.epoch: r.is_best for r in Mx.mark_improvements(e).collect()}
    assert flags == {0: True, 1: True, 2: False, 3: False}


def test_running_mean_spreads_one_run(spark):
    df = spark.range(1000).select(F.lit(1).alias("run"), F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("loss"))
    out = Mx.running_mean(df, ["run"], ["t"], F.floor(F.col("t") / 100), "loss", bucket_bound=11).orderBy("t").collect()
    acc = 0.0
    for i, r in enumerate(out):
        acc += r.loss
        assert r.step == i and abs(r.running_mean - acc / (i + 1)) < 1e-9
    assert [r.step for r in Mx.every_nth(spark.createDataFrame(out), "step", 250).collect()] == [0, 250, 500, 750]
