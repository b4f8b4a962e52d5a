"""Session helpers: builder defaults, checkpoint folder, written tables that cut lineage.

The iterative trainers cut lineage once per iteration by writing a table
into the shared folder named by ``spark.checkpoint.dir``; a private temporary
folder is only made when no folder is configured and the master is local
(tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

APP_NAME = "latentspark"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = APP_NAME, extra: dict | None = None) -> SparkSession:
    """Session with AQE on, the UI off and a checkpoint folder in place.

    Master and shuffle partitions are the launcher's or the cluster's unless
    the caller passes them.
    """
    b = SparkSession.builder.appName(app_name)
    if master is not None:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the master is local is a private folder created (as in tests); on a cluster
    an unset folder is an error, since a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before training")
        configured = tempfile.mkdtemp(prefix="latentspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a written table in the shared checkpoint folder and
    read it back: one job, and the returned frame's lineage starts at those
    files, so loops never grow their plans and a lost executor recomputes
    nothing before the cut.  (Never ``localCheckpoint``.)
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_at = path
    return back


def drop_cut(df: DataFrame | None) -> None:
    """Delete the files of a frame that ``cut`` returned, once nothing reads it any more; other frames are left alone."""
    path = getattr(df, "written_at", None)
    if path:
        spark = df.sparkSession
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
