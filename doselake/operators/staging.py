"""Materialisation of layers (K6, K7, K8) and reuse of staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1_000_000  # so that a file, which one task may read whole, is no large sort


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Silver as a view: nothing is stored, every reader recomputes it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(
    df: DataFrame, base: str, layer: str, name: str, partition_by: str | None = None, dealt: bool = False
) -> DataFrame:
    """Full rebuild of ``base/layer/name`` as Parquet; the stored table is returned.

    An unpartitioned table keeps the partitioning its last shuffle left, which AQE
    has already sized. A table partitioned by a column is rebalanced by it first:
    small values end up in one file, and a value that holds a third of the rows is
    split over several tasks instead of going through one. ``dealt`` says that the rows
    lie by that column already.
    """
    path = f"{base.rstrip('/')}/{layer}/{name}"
    if partition_by:
        writer = (df if dealt else df.hint("rebalance", partition_by)).write.partitionBy(partition_by)
    else:
        writer = df.write
    writer.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    # The written schema, so a partition value like "1996-02" stays text.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publication_size(spark: SparkSession, path: str) -> DataFrame:
    """Rows, files and bytes of a published table (K8), from file metadata."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .agg(F.count("*").alias("arquivos"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    )
    rows = spark.read.parquet(path).agg(F.count("*").alias("linhas"))
    return files.select(rows.scalar().alias("linhas"), "arquivos", "bytes")
