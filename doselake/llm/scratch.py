"""Intermediate tables below the folder all executors share."""

from __future__ import annotations

import atexit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

_MADE: list[tuple[SparkSession, str]] = []


def fresh(spark: SparkSession) -> str:
    """A new shared folder, deleted by `drop` or when Python ends."""
    folder = shared_folder(spark)
    _MADE.append((spark, folder))
    return folder


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` and read it back: its lineage ends at the files."""
    folder = fresh(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_key(doc_id: str = "doc_id", column: str = "text") -> Column:
    """A number for an id and its text, so that rows without an id, and rows that share one,
    are told apart; two different ones are equal once in 10**19 pairs."""
    return F.xxhash64(F.col(doc_id), F.md5(F.col(column)))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text), the id being `row_key`: for stages that judge row by row."""
    return docs.select(row_key().alias("doc_id"), "text")


def without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` less the rows whose `row_key` is a ``doc_id`` of ``found``."""
    (name,) = unused(docs, "_found")
    gone = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, row_key() == F.col(name), "left_anti")


def drop() -> None:
    """Delete every intermediate table made so far; frames over them stop working."""
    while _MADE:
        spark, folder = _MADE.pop()
        if spark.sparkContext._jsc is None:
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _at_exit() -> None:
    try:
        drop()
    except Exception:  # noqa: BLE001 - the JVM may be gone, and its files with it
        _MADE.clear()
