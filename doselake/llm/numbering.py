"""Gapless numbers and running sums over a whole table, without a sort in one task.

Rows are dealt to buckets by an order key; a bucket's total is known before any row in it
is numbered, so only the rows of one bucket ever meet in a task. The table of bucket
totals, at most `BUCKETS` rows a group, is the only thing summed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000
BUCKETS = 1 << 20


def bucket_count(rows: int) -> int:
    return max(1, min(BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def numbered(
    rows: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str
) -> DataFrame:
    """``rows`` with ``name``: 0, 1, ... in each group, by ``bucket`` and ``order`` within it.

    Rows that tie in everything get their numbers in either order. Groups may be null.
    """
    return running(rows, group, bucket, order, F.lit(1), name)


def running(
    rows: DataFrame, group: list[str], bucket: Column, order: list[Column], size: Column, name: str
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``size`` over the rows before it in its group."""
    rows = rows.withColumn("_bucket", bucket).withColumn("_size", size.cast("long"))
    totals = rows.groupBy(*group, "_bucket").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        F.col("_bucket").alias("_of"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
    )
    same = rows["_bucket"] == offsets["_of"]
    for g in group:
        same &= rows[g].eqNullSafe(offsets[f"_{g}"])
    inside = (
        Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered_rows = rows.join(offsets, same).withColumn(
        name, F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    )
    return numbered_rows.drop("_bucket", "_size", "_of", "_before", *[f"_{g}" for g in group])


def first_by(rows: DataFrame, key: str, ties: list[Column], count: int, buckets: int) -> DataFrame:
    """``rows`` with ``first``: whether a row is among the ``count`` smallest by ``key``.

    Rows are counted by buckets of the key. Those of lower buckets than the one in which
    the count is reached are taken, those of higher ones left, without being moved; only
    that bucket is put in order. ``key`` is a double; nulls come last.
    """
    # Grows like the key near zero and like its logarithm far from it.
    rows = rows.withColumn("_bucket", F.floor(F.asinh(F.coalesce(F.col(key), F.lit(1e300))) * buckets))
    totals = rows.groupBy("_bucket").agg(F.count("*").alias("_total"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    crossed = offsets.where(f"_before < {count} and _before + _total > {count}").collect()  # one row, or none
    if not crossed:
        last = offsets.where(f"_before + _total <= {count}").agg(F.max("_bucket")).first()[0]
        return rows.withColumn("first", F.lit(False) if last is None else F.col("_bucket") <= last).drop("_bucket")
    (bucket, _, taken), here = crossed[0], F.col("_bucket")
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col(key).asc_nulls_last(), *ties))
    ordered = rows.where(here == bucket).withColumn("first", nth <= count - taken)
    return rows.where(here != bucket).withColumn("first", here < bucket).unionByName(ordered).drop("_bucket")
