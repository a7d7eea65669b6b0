"""Generated monthly calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_START = "2026-01-01"
DEFAULT_END = "2026-12-01"


def months(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """First days of the months from ``start`` to ``end``, both included."""
    return spark.range(1).selectExpr(
        f"explode(sequence(date'{start}', date'{end}', interval 1 month)) AS mes"
    )
