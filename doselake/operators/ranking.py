"""Global competition rank without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGES = 256
_ACCURACY = 10_000


def _bounds(values: DataFrame, ranges: int) -> Column:
    """Ascending values that part the distinct ``_v`` into about equal ranges; one small array."""
    shares = F.lit([i / ranges for i in range(1, ranges)])
    return values.agg(F.percentile_approx("_v", shares, _ACCURACY).alias("b")).scalar()


def ranged(counts: DataFrame, ranges: int) -> DataFrame:
    """``counts`` with ``_range``, which never decreases as ``_v`` grows; -1 for nulls."""
    value = F.col("_v").cast("double")
    held = counts.withColumn("_bounds", _bounds(counts.select(value.alias("_v")), ranges))
    below = F.coalesce(F.size(F.filter("_bounds", lambda b: b < value)), F.lit(0))
    return held.withColumn("_range", F.when(F.col("_v").isNull(), -1).otherwise(below)).drop("_bounds")


def competition_rank(
    df: DataFrame, value: str, name: str, groups: Sequence[str] = (), ranges: int = RANGES
) -> DataFrame:
    """Add ``name``: 1 + number of rows of the group with a smaller ``value``; ties share
    a rank. Nulls are smaller than any value.

    Equal values are counted first, so a value shared by a third of the rows is
    one row afterwards. The distinct values are parted into ranges that hold about as
    many of them each, wherever they lie; a range's total is known before its values
    are ranked, and the sum of the ranges before it shifts their ranks.
    """
    keys = [f"_g{i}" for i in range(len(groups))]
    counts = df.groupBy(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).alias("_v")).agg(
        F.count("*").alias("_n")
    )
    counts = ranged(counts, ranges)
    before = (
        Window.partitionBy(*keys)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        counts.groupBy(*keys, "_range")
        .agg(F.sum("_n").alias("_in_range"))
        .select(
            *[F.col(k).alias(f"{k}_of") for k in keys],
            F.col("_range").alias("_range_of"),
            F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_offset"),
        )
    )
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same_range = F.col("_range") == F.col("_range_of")
    for k in keys:
        same_range &= F.col(k).eqNullSafe(F.col(f"{k}_of"))
    ranks = (
        counts.withColumn("_below", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(offsets, same_range)
        .select(*keys, "_v", (F.col("_offset") + F.col("_below") + 1).alias(name))
    )
    same_value = F.col(value).eqNullSafe(F.col("_v"))
    for g, k in zip(groups, keys):
        same_value &= F.col(g).eqNullSafe(F.col(k))
    return df.join(ranks, same_value).drop(*keys, "_v")


def worst(df: DataFrame, rank: str, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by rank; a partial top-n per partition, never a full sort."""
    return df.orderBy(rank, key).limit(n)
