"""Distinct counts that can be stored and merged (A8, the approximate option).

An exact distinct count shuffles every distinct value for each way it is sliced. A sketch
has a few kilobytes per slice and month; sketches of months, regions or loads merge to
that of the union, so a report over any of them reads sketches only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 14  # 2**14 registers: a standard error of 0.8 %, at most 16 KB


def sketches(df: DataFrame, value: str, by: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """(by..., esboco): a HyperLogLog sketch of ``value`` per slice; nulls are no value."""
    made = df.where(F.col(value).isNotNull()).groupBy(*by)
    return made.agg(F.hll_sketch_agg(value, precision).alias("esboco"))


def merged(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of coarser slices: the union of those stored."""
    return stored.groupBy(*by).agg(F.hll_union_agg("esboco", True).alias("esboco"))


def estimates(stored: DataFrame, name: str) -> DataFrame:
    return stored.withColumn(name, F.hll_sketch_estimate("esboco")).drop("esboco")
