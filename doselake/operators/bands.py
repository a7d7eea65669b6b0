"""Lookup of values in closed intervals.

Intervals may overlap, leave gaps and have bounds of any size. Their bounds part the line
into elementary segments, inside which the answer does not change, so a value is looked up
by the segment it lies in: an equi-join.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .ranking import competition_rank

SMALL = 4096  # bands up to which their bounds are one array
COVERED = 16  # times as many pairs of a segment and a band that holds there
PER_BLOCK = 1024  # segments that a block of the line holds beyond that


def _whole(bands: DataFrame, low: str, high: str, label: str, name: str) -> DataFrame:
    """The intervals that hold something: name, _low, and _after, where one has ended."""
    return bands.filter(F.col(low) <= F.col(high)).select(
        F.col(label).alias(name),
        F.col(low).cast("bigint").alias("_low"),
        # An interval that ends with the largest number has nothing behind it.
        F.expr(f"CASE WHEN `{high}` < {(1 << 63) - 1} THEN CAST(`{high}` AS bigint) + 1 END").alias("_after"),
    )


def _held(rows: list[Row], small: int) -> tuple[list[int], list[tuple]] | None:
    """Starts in order and (start, label) of all that holds from there on, if they are few."""
    if len(rows) > small:
        return None
    starts = sorted({x for _, low, after in rows for x in (low, after) if x is not None})
    place = {start: i for i, start in enumerate(starts)}
    spans = [(label, place[low], len(starts) if after is None else place[after]) for label, low, after in rows]
    if sum(last - first for _, first, last in spans) > COVERED * max(small, 1):
        return None
    return starts, [(starts[i], label) for label, first, last in spans for i in range(first, last)]


def _segments(whole: DataFrame, numbered: DataFrame, count: int, name: str) -> DataFrame:
    """(_from, name): which intervals hold between a start and the next one."""
    first = numbered.select(F.col("_start").alias("_low"), F.col("_nth").alias("_first"))
    last = numbered.select(F.col("_start").alias("_after"), F.col("_nth").alias("_last"))
    covered = F.sequence("_first", F.coalesce(F.col("_last") - 1, F.lit(count)).cast("long"))
    parts = whole.join(first, "_low").join(last, "_after", "left").select(name, F.explode(covered).alias("_nth"))
    return parts.join(numbered, "_nth").select(F.col("_start").alias("_from"), name)


def _not_above(ascending: Column, value: Column, count: int) -> Column:
    """How many of the ``count`` numbers are not above ``value``, by binary search."""
    steps = F.lit([1 << i for i in reversed(range(count.bit_length()))])

    def step(found: Column, size: Column) -> Column:
        fits = (found + size <= count) & (F.try_element_at(ascending, found + size) <= value)
        return F.when(fits, found + size).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def _swept(values: DataFrame, starts: DataFrame, count: int, per_block: int) -> DataFrame:
    """(_value, _from): starts and values in one order, each value taking the last start before it.

    The line is cut into blocks of starts, so a block is one task's sort. A value before
    the first start of its block belongs to the last start of the blocks before.
    """
    blocks = max(2, -(-count // per_block))
    shares = F.lit([i / blocks for i in range(1, blocks)])
    cuts = starts.agg(F.percentile_approx("_start", shares, 100 * blocks).alias("b")).scalar()
    events = starts.select(F.col("_start").alias("_at"), "_start").unionByName(
        values.select(F.col("_value").alias("_at"), F.lit(None).cast("bigint").alias("_start"))
    )
    # A subquery is a column first: functions over arrays take none.
    events = events.withColumn("_cuts", cuts)
    events = events.withColumn("_block", _not_above(F.col("_cuts"), F.col("_at"), blocks - 1)).drop("_cuts")
    order = Window.partitionBy("_block").orderBy("_at", F.col("_start").isNull())
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lasts = events.groupBy("_block").agg(F.max("_start").alias("_last"))
    lasts = lasts.agg(F.sort_array(F.collect_list("_last")).alias("b")).scalar()  # one a block
    earlier = F.array_max(F.filter("_lasts", lambda last: last < F.col("_at")))
    return (
        events.withColumn("_own", F.last("_start", ignorenulls=True).over(order))
        .where("_start IS NULL")
        .withColumn("_lasts", lasts)
        .select(F.col("_at").alias("_value"), F.coalesce("_own", earlier).alias("_from"))
    )


def with_band(
    df: DataFrame,
    value: Column,
    bands: DataFrame,
    *,
    low: str = "idade_min",
    high: str = "idade_max",
    label: str = "ordem",
    name: str = "faixa",
    small: int = SMALL,
    per_block: int = PER_BLOCK,
) -> DataFrame:
    """Left-join the bands whose closed interval holds the whole number ``value``.

    Null or reversed bounds hold nothing, a null or unmatched value gets a null band, and
    overlapping bands fan out as the range condition would. The bands are counted first: up
    to ``small`` of them are put in order on the driver, and a value finds its segment in a
    sorted array; beyond, the distinct values and the bounds are sorted together, block by
    block.
    """
    kind = bands.schema[label].dataType
    whole = _whole(bands, low, high, label, name)
    held = _held(whole.limit(small + 1).collect(), small)
    point = value.cast("bigint")
    if held is None:
        starts = whole.select(F.explode(F.array("_low", "_after")).alias("_start"))
        starts = starts.where("_start IS NOT NULL").distinct()
        count = starts.count()
        numbered = competition_rank(starts, "_start", "_nth")
        valued = df.withColumn("_value", point)
        distinct = valued.select("_value").where("_value IS NOT NULL").distinct()
        placed = valued.join(_swept(distinct, starts, count, per_block), "_value", "left").drop("_value")
        return placed.join(_segments(whole, numbered, count, name), "_from", "left").drop("_from")
    starts, labels = held
    if not starts:
        return df.withColumn(name, F.lit(None).cast(kind))
    ascending = F.lit(starts)
    found = _not_above(ascending, point, len(starts))
    placed = df.withColumn("_from", F.when(found > 0, F.try_element_at(ascending, found)))
    table = pa.table({"_from": pa.array([s for s, _ in labels], pa.int64()), name: [b for _, b in labels]})
    # As many rows as `_held` allows.
    parts = F.broadcast(df.sparkSession.createDataFrame(table)).withColumn(name, F.col(name).cast(kind))
    return placed.join(parts, "_from", "left").drop("_from")
