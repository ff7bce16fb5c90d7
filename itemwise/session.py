"""Session helpers: a local session for tests and the bench, and the
checkpoint directory rule used by the batch job."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "itemwise", extra: dict | None = None) -> SparkSession:
    """A local session configured like a small cluster: AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ITEMWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    Uses the directory already set on the context, else the cluster's
    ``spark.checkpoint.dir``. Only a local-mode session (tests, bench) with
    neither gets a fresh scratch folder; a cluster session without a shared
    checkpoint directory is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="itemwise-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) so checkpoints survive executor loss")


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Queries that run inside leave no shuffle files: executors delete those of
    a query when it has ended, not when the driver's memory is next collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str = "table", keep: list | None = None) -> DataFrame:
    """Write ``df`` once as a parquet table under the session's checkpoint
    directory (shared storage on a cluster) and read it back, cutting the
    lineage. One pass and no executor cache, compressed columnar storage for
    every later read, and exact sizes for AQE's join choices; a lost executor
    costs a re-read, not a recomputation. An aggregate that is written before
    it is joined on its own key is a plain scan, so AQE can split that join
    when the key is hot. The table is appended to ``keep`` for a caller that
    drops it."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/itemwise/{name}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._itemwise_path = path
    if keep is not None:
        keep.append(table)
    return table


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage; a missing one is no error."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files behind a frame returned by ``materialize``."""
    delete_path(df.sparkSession, df._itemwise_path)
