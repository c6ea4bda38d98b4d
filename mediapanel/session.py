"""Spark session helpers.

Operators never create sessions; they take DataFrames. These helpers exist for
tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every job in this package assumes: UTC wall clock (local
# dates are derived explicitly per market), ANSI arithmetic, AQE on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "mediapanel") -> SparkSession:
    """Local session for tests and the bench (a cluster supplies its own)."""
    master = master or os.environ.get("MEDIAPANEL_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("MEDIAPANEL_DRIVER_MEM", "8g")))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


INPUT_PER_PARTITION = 4 << 20  # bytes of parquet; a row of it is some 25 times wider in a sort
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, paths: list[str]) -> int:
    """Let AQE start its shuffles from as many partitions as the bytes under
    ``paths`` need to be sorted and hashed in memory; it merges small ones to
    the session's advisory size. Only ever raises the number, never the
    session's own ``spark.sql.shuffle.partitions``. Returns it."""
    from .sources.io import _fs
    size = 0
    for path in paths:
        fs, p = _fs(spark, path)
        size += sum(f.getLen() if f.isFile() else fs.getContentSummary(f.getPath()).getLength()
                    for f in fs.globStatus(p) or ())
    n = max(-(-size // INPUT_PER_PARTITION), int(spark.conf.get(INITIAL_PARTITIONS, None) or 0),
            int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    return n


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Remove the shuffle files of each write that is started in this block when
    it ends: otherwise those of all tables of a load stay on the disks until the
    driver's garbage collector comes by them. (From Spark 4.1; older versions
    ignore the setting.)"""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` when it is set. Unset, a session that runs
    in one local process (tests, the bench) gets a scratch folder; a cluster
    has to name a folder that all its machines share."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that all machines share")
    path = tempfile.mkdtemp(prefix="mediapanel-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path
