import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from corpusforge.session import CHECKPOINT_CONF

    ckpt = tempfile.mkdtemp(prefix="cf-test-ckpt-")
    s = (SparkSession.builder.master("local[4,4]").appName("corpusforge-tests")  # task retries on
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.host", "127.0.0.1")
         .config(CHECKPOINT_CONF, ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from corpusforge.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cf-test-")


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
