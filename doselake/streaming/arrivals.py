"""Loading drops as they arrive: the batch load, fed by a file stream.

The stream only discovers files (their bytes are read by the load itself); its
checkpoint remembers which were seen, so each run takes up the new ones. A month is
replaced as a whole, so a batch repeated after a failure leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import load

_ARRIVALS = "path string, modificationTime timestamp, length bigint, content binary"


def _drops_of(batch: DataFrame) -> list[str]:
    """The drops the new files belong to: a part file stands for its whole folder,
    since part of a drop must not replace the month of all of it."""
    folder = F.regexp_extract("path", r"^(.*\.csv)/[^/]+$", 1)
    drop = F.when(folder != "", folder).otherwise(F.col("path"))
    return sorted(r[0] for r in batch.select(drop).distinct().collect())


def _problems_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}_problemas"


def problems(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(lote, problema) of a stream's batches so far; raises as Spark does where none was stored."""
    stored = spark.read.schema("problema string, lote long").parquet(_problems_folder(checkpoint))
    return stored.select("lote", "problema")


def follow(
    spark: SparkSession,
    folder: str,
    table: str,
    log_table: str,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Load every drop below ``folder`` not loaded yet, then stop.

    ``options`` are those of :func:`doselake.operators.load.load`. A file with
    problems does not stop the stream: the others are loaded and logged, the problems
    are stored, and :func:`problems` lists them.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(_ARRIVALS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select("path")
    )

    def load_batch(batch: DataFrame, number: int) -> None:
        found = _drops_of(batch)
        if not found:
            return
        report = load.load(spark, found, table, log_table, **options)
        if report.problems:
            told = spark.createDataFrame([(p,) for p in report.problems], "problema string")
            # One folder a batch: a batch that is repeated replaces its own problems.
            told.write.mode("overwrite").parquet(f"{_problems_folder(checkpoint)}/lote={number}")

    return (
        arrivals.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
