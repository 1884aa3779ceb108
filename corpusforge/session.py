"""Session construction and the shared checkpoint folder.

Library functions never create a session; they take DataFrames.  This
module is for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "corpusforge") -> SparkSession:
    """Local session with AQE on and the web UI off."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` wins.  Only when it is
    unset on a local master (tests) do we create a scratch folder of our own;
    on a cluster an unset folder is an error, as a machine-local one would
    not be seen by the executors.
    """
    sc = spark.sparkContext
    path = (spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
            or sc.getCheckpointDir())
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor sees (master {sc.master})")
        path = tempfile.mkdtemp(prefix="corpusforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # noqa: BLE001 - some deployments refuse runtime changes of core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Spread a table just read (asking a shuffled plan for its partitions would
    run it) as fewer partitions than the cluster has cores (e.g. one large Parquet row group) before CPU-heavy row-wise work.
    A table read as many partitions -- the normal case for large inputs -- is
    returned unchanged, so no shuffle is added at scale."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
