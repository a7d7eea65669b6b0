"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

_SESSION_DEFAULTS = {
    # Every instant is read and written in UTC, so casts do not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task that writes a few months keeps their files open instead of sorting;
    # few enough that their row groups fit in memory, beyond that it sorts.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the rules depend on to an existing session."""
    for key, value in _SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "doselake", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        # Megabyte-sized test data: let rebalanced writes still use every core.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, deleted when Python ends.

    On a cluster that setting names storage every executor can reach. Only a
    local master, which has one machine, may run without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    folder = f"{base.rstrip('/')}/doselake-{uuid.uuid4().hex}"
    _made.append((spark, folder))
    return folder


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="doselake-")


def hadoop_path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(uri)


def delete_folder(spark: SparkSession, uri: str) -> None:
    path = hadoop_path(spark, uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_made: list[tuple[SparkSession, str]] = []


@atexit.register
def _clean() -> None:
    for spark, folder in _made:
        try:
            delete_folder(spark, folder)
        except Exception:  # noqa: BLE001 - its session has ended; a later one cannot know the folder
            return
