"""Spark session defaults for the affinity jobs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: removes a job's shuffle files when it ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "affinity", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return a session configured for these jobs.

    On a cluster the master and most sizing come from spark-submit; only
    settings the jobs rely on are pinned here (AQE with skew-join splitting,
    UTC dates, no UI server).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    # sizes belong to the cluster: a submitted value stays unless the caller names another
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if "AFFINITY_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["AFFINITY_DRIVER_MEMORY"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only when it is
    unset and the master is local (local runs and tests) a fresh folder is
    created and registered; on a cluster an unset value is an error, never a
    machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    # local runs and tests only: the driver is the only machine
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="affinity-ckpt-"))
    return sc.getCheckpointDir()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The table replaces the shuffle files of the job that makes it: they go when the job ends.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_checkpoints(spark: SparkSession) -> None:
    """Delete this session's checkpoint folder; call it when no result depends on it any more."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        path = spark._jvm.org.apache.hadoop.fs.Path(current)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        sc.setCheckpointDir(current.rsplit("/", 1)[0])
