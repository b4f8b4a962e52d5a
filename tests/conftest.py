import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="ls-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("latentspark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from latentspark.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="ls-test-")


# Fixture of the reference's specs: 3 users × 4 items, rank 2.
ALPHA = {0: [1.0, 2.0], 1: [3.0, 4.0], 2: [5.0, 6.0]}
BETA = {0: [8.0, 7.0], 1: [6.0, 5.0], 2: [4.0, 3.0], 3: [2.0, 1.0]}
Y = [[22, 16, 10, 4], [52, 38, 24, 10], [82, 60, 38, 16]]


@pytest.fixture()
def exact(spark):
    uf = spark.createDataFrame([(i, v) for i, v in ALPHA.items()], "id int, features array<double>")
    vf = spark.createDataFrame([(i, v) for i, v in BETA.items()], "id int, features array<double>")
    r = spark.createDataFrame([(u, i, float(Y[u][i])) for u in range(3) for i in range(4)],
                              "user int, item int, rating double")
    return r, uf, vf


def to_dict(df, col="features"):
    return {row["id"]: list(row[col]) for row in df.collect()}
