"""Ordering, positions, sampling and splitting.

DataFrames have no order, so every positional operation of the reference
(shuffle, first-N, tail split, batch plan) is expressed through an explicit
*order key* and the global dense position under it (X1).

X1 never moves all rows into one task.  Rows are range-partitioned by a
coarse *bucket* that is monotone in the order key (for hash keys: a hex
prefix, so buckets are uniform and no bucket is hot).  Inside a bucket a
window gives the local row number and running sums; the per-bucket totals
form a table with one row per bucket, whose exclusive prefix sums are
broadcast back.  The bucket table's size is bounded by the bucket count,
which is chosen from the row count.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.session import cut_lineage

BUCKET = "_bucket"
#: at most this many rows share one window partition inside X1
TARGET_ROWS_PER_BUCKET = 200_000
#: the same where rows carry their texts (a few kilobytes each)
TARGET_WHOLE_ROWS = 20_000
#: above this many buckets the offsets table is shuffle-joined, not broadcast
MAX_BROADCAST_BUCKETS = 2_000_000


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def order_key(seed: int | str, *cols: Column | str) -> Column:
    """Deterministic shuffle key: ``md5('<seed>:<col>...')`` (DuckDB-portable)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols]))


def hex_digits_for(n_rows: int, target: int = TARGET_ROWS_PER_BUCKET, partitions: int = 1) -> int:
    """Hex-prefix length so that a bucket holds at most about ``target`` rows and
    there are at least as many buckets as ``partitions``."""
    return max(1, math.ceil(math.log(max(n_rows / target, 1), 16)), math.ceil(math.log(max(partitions, 1), 16)))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hex_bucket(key: Column | str, digits: int) -> Column:
    """Coarse bucket of an md5 hex key: its first ``digits`` characters."""
    return F.substring(_c(key), 1, digits)


def global_position(
    df: DataFrame,
    order_cols: Sequence[Column | str],
    bucket: Column | None,
    partition_cols: Sequence[str] = (),
    sums: Mapping[str, Column | str] | None = None,
    pos_col: str = "pos",
    total_col: str = "n_total",
    num_partitions: int | None = None,
    bucket_bound: int = 16 ** 3,
    partition_fanout: int = 1,
    once: bool = False,
) -> DataFrame:
    """0-based dense position under ``order_cols`` (restarting per
    ``partition_cols``), the group size, and for every entry of ``sums`` the
    exclusive running sum ``<name>_offset`` and group total ``<name>_total``.

    ``bucket`` must be non-decreasing in ``order_cols``.  The order must be a
    total order (end it with a unique column).  The output keeps ``BUCKET``
    and stays range-partitioned by it, so a later prefix sum over the same
    buckets (``bucket=None``: reuse the existing column and partitioning)
    needs no further shuffle.  ``bucket_bound`` bounds the distinct bucket
    values and ``partition_fanout`` the distinct partition keys; their
    product bounds the broadcast offsets table.  Each row also gets the first
    value and the end of every running sum in its bucket, ``<name>_run_start``
    and ``<name>_run_end``.

    The rows are read for the bucket totals and for the positions.  ``once``
    keeps the range-partitioned rows (memory and disk), so that the input is
    read and shuffled once, however often the result is used.
    """
    sums = dict(sums or {})
    if num_partitions is None:
        num_partitions = shuffle_partitions(df)
    keys = list(partition_cols) + [BUCKET]
    if bucket is None:
        d = tagged = df
    else:
        tagged = df.withColumn(BUCKET, bucket)
        # explicit partition count: AQE keeps the range bounds as they are
        d = tagged.repartitionByRange(num_partitions, *[F.col(k) for k in keys])
        if once:
            d = tagged = d.persist(StorageLevel.MEMORY_AND_DISK)
    w = Window.partitionBy(*keys).orderBy(*[_c(c) for c in order_cols])
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = d.withColumn("_lrn", F.row_number().over(w))
    for name, v in sums.items():
        local = local.withColumn(f"_lsum_{name}", F.sum(_c(v)).over(run))

    aggs = [F.count(F.lit(1)).alias("_bcnt")] + [
        F.sum(_c(v)).alias(f"_bsum_{name}") for name, v in sums.items()]
    # totals aggregate map-side before their (tiny) shuffle
    totals = tagged.groupBy(*keys).agg(*aggs)
    tw = Window.partitionBy(*partition_cols).orderBy(BUCKET)
    before = tw.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*partition_cols)
    offs = totals.select(
        *keys,
        F.coalesce(F.sum("_bcnt").over(before), F.lit(0)).alias("_ocnt"),
        F.sum("_bcnt").over(whole).alias(total_col),
        *[F.coalesce(F.sum(f"_bsum_{n}").over(before), F.lit(0)).alias(f"_osum_{n}") for n in sums],
        *[F.sum(f"_bsum_{n}").over(whole).alias(f"{n}_total") for n in sums],
        *[F.col(f"_bsum_{n}") for n in sums],
    )
    if bucket_bound * partition_fanout <= MAX_BROADCAST_BUCKETS:
        offs = F.broadcast(offs)
    out = local.join(offs, on=keys, how="inner")
    out = out.withColumn(pos_col, F.col("_ocnt") + F.col("_lrn") - 1)
    for name, v in sums.items():
        out = out.withColumns({f"{name}_offset": F.col(f"_osum_{name}") + F.col(f"_lsum_{name}") - _c(v),
                               f"{name}_run_start": F.col(f"_osum_{name}"),
                               f"{name}_run_end": F.col(f"_osum_{name}") + F.col(f"_bsum_{name}")})
    drop = ["_lrn", "_ocnt"] + [f"_{x}_{n}" for n in sums for x in ("lsum", "osum", "bsum")]
    return out.drop(*drop)


# ---------------------------------------------------------------- D operators

def shuffle_positions(df: DataFrame, id_col: str, seed: int = 42,
                      key_col: str = "order_key", digits: int | None = None,
                      partition_cols: Sequence[str] = (), sums=None,
                      pos_col: str = "pos", total_col: str = "n_total", once: bool = False) -> DataFrame:
    """Deterministic permutation; adds ``order_key``, ``pos``, ``n_total``."""
    if digits is None:
        digits = hex_digits_for(df.count(), partitions=shuffle_partitions(df))
    d = df.withColumn(key_col, order_key(seed, id_col))
    return global_position(d, [key_col, id_col], hex_bucket(key_col, digits),
                           partition_cols=partition_cols, sums=sums,
                           pos_col=pos_col, total_col=total_col, bucket_bound=16 ** digits, once=once)


def exact_fraction_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """The first ``floor(n * fraction)`` rows of the seeded permutation."""
    d = shuffle_positions(df, id_col, seed)
    return d.where(F.col("pos") < F.floor(F.col("n_total") * F.lit(float(fraction))))


def exact_n_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """D3: ``min(n, total)`` rows without replacement, original ids kept."""
    d = shuffle_positions(df, id_col, seed)
    return d.where(F.col("pos") < F.lit(int(n)))


def prefix_n(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """First ``n`` rows in input (id) order; may return fewer.

    An approximate quantile a little above the n-th id bounds the rows that can
    be among the first ``n``, exactly counted; only those are numbered, and the
    bound is a filter the scan can use.  ``n_total`` counts the whole table."""
    total = df.count()
    share = n / total if total else 1.0
    bound = None
    while share < 1.0:
        share = min(1.0, share + 0.0005)
        q = df.agg(F.percentile_approx(F.col(id_col), share, 10_000)).first()[0]
        near = F.col(id_col).isNull() | (F.col(id_col) <= F.lit(q))
        if q is not None and df.where(near).count() >= n:
            bound = near
            break
        share *= 1.5
    d = input_positions(df if bound is None else df.where(bound), id_col)
    return d.where(F.col("pos") < F.lit(int(n))).withColumn("n_total", F.lit(total).cast("long"))


def quantile_buckets(df: DataFrame, col: str, n_buckets: int, out_col: str = "_qbucket") -> DataFrame:
    """Adds a bucket index monotone in ``col`` with about equal row counts
    per bucket, whatever the key distribution: approximate quantiles (one
    aggregate) give the boundaries, and ML's ``Bucketizer`` assigns buckets
    by binary search on the JVM.  At most ``n_buckets`` distinct values."""
    from pyspark.ml.feature import Bucketizer

    if n_buckets <= 1:
        return df.withColumn(out_col, F.lit(0).cast("long"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    # ten times finer than the buckets, so that none is empty or doubled for want of accuracy
    bounds = df.select(F.percentile_approx(F.col(col).cast("double"), probs, max(10_000, 10 * n_buckets)).alias("q")).first()["q"]
    splits = [float("-inf")] + sorted({float(b) for b in (bounds or [])}) + [float("inf")]
    tmp = "_qb_in"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out_col, handleInvalid="keep")
    return (b.transform(df.withColumn(tmp, F.col(col).cast("double")))
            .withColumn(out_col, F.col(out_col).cast("long")).drop(tmp))


def input_positions(df: DataFrame, id_col: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """X1 over the input order (a numeric id), for head splits and prefixes.

    Buckets come from approximate quantiles of the id, so gaps or clusters in
    the ids do not make a hot bucket.  The rows come whole, with their texts, so
    a task gets one bucket, smaller than X1's."""
    n_buckets = max(1, math.ceil(df.count() / TARGET_WHOLE_ROWS))
    d = quantile_buckets(df, id_col, n_buckets)
    return global_position(d, [id_col], F.col("_qbucket"), partition_cols=partition_cols,
                           num_partitions=max(shuffle_partitions(df), n_buckets + 1), bucket_bound=n_buckets + 1).drop("_qbucket")


def label_split(pos: Column, n_total: Column, val_ratio: float, val_at: str = "tail") -> Column:
    """D5/D6 label: ``val = floor(n * r)`` rows go to validation, at the tail or head."""
    n_val = F.floor(n_total * F.lit(float(val_ratio)))
    if val_at == "tail":
        return F.when(pos < n_total - n_val, F.lit("train")).otherwise(F.lit("validation"))
    if val_at == "head":
        return F.when(pos < n_val, F.lit("validation")).otherwise(F.lit("train"))
    raise ValueError(val_at)


def tail_split(df: DataFrame, id_col: str, val_ratio: float = 0.01, seed: int = 42,
               digits: int | None = None, once: bool = False) -> DataFrame:
    """D5 (and D7): shuffle, then the last ``floor(n*r)`` rows are validation.

    ``digits`` (bucket granularity) may come from an upper bound of the row
    count, e.g. the unfiltered source's count, which Parquet answers from
    metadata."""
    d = shuffle_positions(df, id_col, seed, digits=digits, once=once)
    return d.withColumn("split", label_split(F.col("pos"), F.col("n_total"), val_ratio, "tail"))


def tail_train(df: DataFrame, id_col: str, val_ratio: float = 0.01, seed: int = 42, digits: int | None = None) -> DataFrame:
    """The training rows of :func:`tail_split`, without moving any row.

    Only the order keys are kept; counts per bucket and the distinct keys of one
    bucket give the key at which validation begins, and smaller keys train.  If
    rows of one id lie on both sides, the rows are numbered after all."""
    keys = cut_lineage(df.select(order_key(seed, id_col).alias("_key")))
    if digits is None:
        digits = hex_digits_for(keys.count(), partitions=shuffle_partitions(df))
    bucket = hex_bucket("_key", digits)
    sizes = sorted((r["_bucket"], r["n"]) for r in keys.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in sizes)
    before = total - math.floor(total * float(val_ratio))      # training rows in buckets not yet passed
    if before >= total:
        return df
    for b, n in sizes:
        if before < n:
            break
        before -= n
    upto = F.sum("n").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    copies = keys.where(bucket == F.lit(b)).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    first = copies.withColumn("_upto", upto).where(F.col("_upto") > before).orderBy("_key").first()
    if first["_upto"] - first["n"] < before:
        return tail_split(df, id_col, val_ratio, seed, digits).where("split = 'train'").select(*df.columns)
    return df.where(order_key(seed, id_col) < F.lit(first["_key"]))


def head_split(df: DataFrame, id_col: str, val_ratio: float = 0.1) -> DataFrame:
    """validation = the first ``floor(n*r)`` rows in input order, unshuffled."""
    d = input_positions(df, id_col)
    return d.withColumn("split", label_split(F.col("pos"), F.col("n_total"), val_ratio, "head"))


def random_split(df: DataFrame, id_col: str, val_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """Exact-size random split ``[n - int(n*r), int(n*r)]`` (not ``randomSplit``)."""
    return tail_split(df, id_col, val_ratio, seed)


def pool(*dfs: DataFrame) -> DataFrame:
    """Concatenate several tables by column name, duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def capped_train_sample(split_df: DataFrame, cap: int = 100_000) -> DataFrame:
    """The first ``min(cap, n_train)`` training rows in split order."""
    return split_df.where((F.col("split") == "train") & (F.col("pos") < F.lit(int(cap))))


#: steps a row may walk outside [0, n); each is taken with a chance below 1 / sqrt(n)
WALK = 64


def keyed_permutation(pos: Column, n: Column, key: Column, rounds: int = 4) -> Column:
    """A bijection of [0, n) chosen by ``key``, by arithmetic on each row alone.

    A position is a cell of a grid of ``a = ceil(sqrt(n))`` rows and
    ``b = ceil(n / a)`` columns; a Feistel round adds a hash of the column to the
    row, or of the row to the column, and keeps the grid's cells distinct.  Fewer
    than ``a`` cells lie outside [0, n); a position that falls on one walks on
    until it is inside, which no walk of ``min(a, WALK)`` steps fails to reach for
    ``a <= WALK`` and with a chance of ``a ** -WALK`` otherwise.  The hash is the
    first 15 hex digits of md5('<key>:<round>:<value>'), as any SQL engine states it.
    """
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    b = F.ceil(n / a).cast("long")

    def mixed(i: int, value: Column, size: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(i)), value.cast("string")))
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size

    def add(i: int):
        # one-argument functions: Spark reads a second parameter as the index
        if i % 2 == 0:
            return lambda v: F.struct(((v["r"] + mixed(i, v["c"], a)) % a).alias("r"), v["c"].alias("c"))
        return lambda v: F.struct(v["r"].alias("r"), ((v["c"] + mixed(i, v["r"], b)) % b).alias("c"))

    def step(x: Column) -> Column:
        # arrays of one cell: a round names the cell before it instead of repeating it
        cell = F.array(F.struct(F.floor(x / b).cast("long").alias("r"), (x % b).alias("c")))
        for i in range(rounds):
            cell = F.transform(cell, add(i))
        return F.transform(cell, lambda v: v["r"] * b + v["c"])[0]

    return F.aggregate(F.sequence(F.lit(1), F.least(a, F.lit(WALK)).cast("int")), step(pos.cast("long")),
                       lambda x, _: F.when(x < n, x).otherwise(step(x)))


def epoch_batches(df: DataFrame, id_col: str, epochs: int, batch_size: int, drop_last: bool = False,
                  seed_offset: int = 0) -> DataFrame:
    """D10 without a sort per epoch: one position per row (X1), and in every
    epoch the keyed permutation of it.  ``epoch, pos, batch_id`` + input columns.

    The rows are positioned once; an epoch adds rows but no exchange, so the
    plan for one epoch can also be computed alone, when it is due."""
    d = shuffle_positions(df, id_col, seed_offset, pos_col="_base", once=True)
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    d = d.withColumn("pos", keyed_permutation(F.col("_base"), F.col("n_total"), F.col("epoch") + F.lit(seed_offset)))
    d = d.withColumn("batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("long"))
    if drop_last:
        d = d.where(F.col("batch_id") < F.floor(F.col("n_total") / F.lit(batch_size)))
    return d.drop("_base", "order_key", BUCKET)


def batch_plan(df: DataFrame, id_col: str, epochs: int, batch_size: int,
               drop_last: bool = False, shuffle: bool = True, seed_offset: int = 0) -> DataFrame:
    """Per epoch, a fresh permutation (seed = epoch) cut into batches.

    Returns ``epoch, <id_col>, pos, batch_id`` (+ input columns).  Epochs are
    generated with ``explode`` (no join); positions restart per epoch.
    """
    n = df.count()
    nb = max(1, math.ceil(n / TARGET_ROWS_PER_BUCKET))
    if not shuffle:
        df = quantile_buckets(df, id_col, nb)
    d = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    if shuffle:
        d = d.withColumn("order_key", order_key_expr_epoch(seed_offset, id_col))
        digits = hex_digits_for(n, partitions=shuffle_partitions(df))
        d = global_position(d, ["order_key", id_col], hex_bucket("order_key", digits),
                            partition_cols=["epoch"], bucket_bound=16 ** digits,
                            partition_fanout=epochs)
    else:
        d = global_position(d, [id_col], F.col("_qbucket"), partition_cols=["epoch"],
                            bucket_bound=nb + 1, partition_fanout=epochs).drop("_qbucket")
    d = d.withColumn("batch_id", F.floor(F.col("pos") / F.lit(batch_size)).cast("long"))
    if drop_last:
        d = d.where(F.col("batch_id") < F.floor(F.col("n_total") / F.lit(batch_size)))
    return d


def order_key_expr_epoch(seed_offset: int, id_col: str) -> Column:
    """Order key of one epoch: ``md5('<epoch + offset>:<id>')``."""
    return F.md5(F.concat_ws(":", (F.col("epoch") + F.lit(seed_offset)).cast("string"),
                             F.col(id_col).cast("string")))


def step_counts(plan: DataFrame, grad_accum: int = 1) -> DataFrame:
    """Batches and optimizer steps per epoch; a trailing partial
    accumulation group is never stepped."""
    per_epoch = plan.groupBy("epoch").agg(F.countDistinct("batch_id").alias("n_batches"))
    return per_epoch.select(
        "epoch", "n_batches",
        F.floor(F.col("n_batches") / F.lit(grad_accum)).cast("long").alias("n_steps"))
