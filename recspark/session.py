"""Session and shared-storage helpers.

The library never invents storage locations on a cluster: iterative
operators cut lineage by writing tables into the folder named by
``spark.checkpoint.dir`` (:func:`materialize`).  Only a local-mode session
(tests, bench) without that setting gets a fresh folder under /tmp.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "recspark", extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench.  Production callers bring their own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.default.parallelism": str(shuffle_partitions or 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    }
    conf.update(extra or {})
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session first (``spark.checkpoint.dir`` or a folder set on
    the SparkContext).  Only a local-mode session may fall back to a new
    folder under /tmp; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recspark-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...)")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path for a written intermediate table, next to the checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write ``df`` as a table into the shared checkpoint folder and read it back.

    Survives executor loss (the files are on shared storage) and, unlike a
    Dataset checkpoint, carries no statistics or constraints of the origin
    plan, so iterative loops keep a constant plan size.  Never localCheckpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # the schema is known: no job that reads footers


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and cached blocks of finished jobs that nothing refers to any more.

    Spark notices them when the driver's JVM collects its garbage, which a driver with a roomy heap may not do for a whole
    chain of fits.  Drop references (models, DataFrames) first.
    """
    gc.collect()  # references from Python, cyclic ones too
    spark.sparkContext._jvm.System.gc()
