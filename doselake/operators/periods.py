"""Month-on-month and year-to-date over a gap-free calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def on_calendar(
    monthly: DataFrame, calendar: DataFrame, month: str, groups: Sequence[str], value: str
) -> DataFrame:
    """``monthly`` with a row for every calendar month of every group.

    Months outside the calendar are dropped; months without data get a null.
    Each group is unrolled over the month list and met with its data by one
    aggregate, so neither a cross join nor a null-sensitive join is needed.
    """
    if groups:
        months = calendar.agg(F.array_sort(F.collect_set(month)))
        grid = (
            monthly.select(*groups)
            .distinct()
            .withColumn("_months", months.scalar())
            .select(*groups, F.explode("_months").alias(month))
        )
    else:
        grid = calendar.select(month)
    empty = F.lit(None).cast(monthly.schema[value].dataType)
    grid = grid.select(*groups, month, empty.alias(value), F.lit(True).alias("_listed"))
    data = monthly.select(*groups, month, value, F.lit(None).cast("boolean").alias("_listed"))
    return (
        grid.unionByName(data)
        .groupBy(*groups, month)
        .agg(F.sum(value).alias(value), F.max("_listed").alias("_listed"))
        .filter("_listed")
        .drop("_listed")
    )


def previous_month(
    series: DataFrame, month: str, groups: Sequence[str], value: str, name: str
) -> DataFrame:
    """Value of the month before; null where the calendar has no such month."""
    w = Window.partitionBy(*groups).orderBy(month)
    follows = F.lag(month).over(w) == F.add_months(month, -1)
    return series.withColumn(name, F.when(follows, F.lag(value).over(w)))


def year_to_date(
    series: DataFrame, month: str, groups: Sequence[str], value: str, name: str
) -> DataFrame:
    """Running sum that restarts every January."""
    w = (
        Window.partitionBy(*groups, F.year(month))
        .orderBy(month)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return series.withColumn(name, F.sum(value).over(w))
