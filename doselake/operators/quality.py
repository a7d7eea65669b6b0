"""Declarative data-quality checks (Q1-Q7): one result row per check.

Counting rules: ``unique`` counts the values that occur more than once,
``not_null`` the null rows, ``accepted_values`` the distinct values outside the
list, ``relationships`` the child rows without a parent. Nulls pass every check
but ``not_null``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIQUE = "unique"
NOT_NULL = "not_null"
ACCEPTED = "accepted_values"
RELATED = "relationships"
ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    severity: str = ERROR
    where: str | None = None
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_key: str | None = None


class QualityError(Exception):
    """An error-level check failed; what depends on the table must not be built."""


def _scoped(df: DataFrame, check: Check) -> DataFrame:
    return df.filter(check.where) if check.where else df


def _unique_failures(df: DataFrame, check: Check) -> DataFrame:
    values = _scoped(df, check).filter(F.col(check.column).isNotNull())
    repeated = values.groupBy(check.column).agg(F.count("*").alias("_n")).filter("_n > 1")
    return repeated.agg(F.count("*").alias("failures"))


def _accepted_failures(df: DataFrame, check: Check) -> DataFrame:
    strange = _scoped(df, check).filter(~F.col(check.column).isin(*check.values))
    return strange.select(check.column).distinct().agg(F.count("*").alias("failures"))


def _related_failures(df: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    # Children are counted per key first: the anti join meets every key once.
    children = (
        _scoped(df, check)
        .filter(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("_k"))
        .agg(F.count("*").alias("_n"))
    )
    keys = parent.select(F.col(check.parent_key).alias("_p"))
    orphans = children.join(keys, F.col("_k") == F.col("_p"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


def _row(failures: DataFrame, check: Check) -> DataFrame:
    return failures.select(
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"),
        F.lit(check.severity).alias("severity"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def _not_null_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All null checks of one table in one pass over its checked columns."""
    results = []
    for check in checks:
        scope = F.expr(check.where) if check.where else F.lit(True)
        nulls = F.count(F.when(scope & F.col(check.column).isNull(), 1))
        results.append(
            F.struct(
                F.lit(check.table).alias("table"),
                F.lit(check.column).alias("column"),
                F.lit(check.kind).alias("check"),
                F.lit(check.severity).alias("severity"),
                nulls.alias("failures"),
            )
        )
    return df.agg(F.array(*results).alias("_r")).select(F.inline("_r"))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Results of ``checks`` as (table, column, check, severity, failures, passed)."""
    checks = list(checks)
    parts: list[DataFrame] = []
    for table in dict.fromkeys(c.table for c in checks if c.kind == NOT_NULL):
        own = [c for c in checks if c.table == table and c.kind == NOT_NULL]
        parts.append(_not_null_rows(tables[table], own))
    for check in checks:
        df = tables[check.table]
        if check.kind == UNIQUE:
            parts.append(_row(_unique_failures(df, check), check))
        elif check.kind == ACCEPTED:
            parts.append(_row(_accepted_failures(df, check), check))
        elif check.kind == RELATED:
            parts.append(_row(_related_failures(df, check, tables[check.parent]), check))
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("passed", F.col("failures") == 0)


def gate(results: DataFrame) -> list[str]:
    """Raise on a failed error-level check; return the failed warnings.

    Only the failed rows of the bounded result table reach the driver.
    """
    failed = results.filter(~F.col("passed")).collect()
    texts = {
        level: [
            f"{r['table']}.{r['column']} {r['check']}: {r['failures']}"
            for r in failed
            if r["severity"] == level
        ]
        for level in (ERROR, WARN)
    }
    if texts[ERROR]:
        raise QualityError("; ".join(texts[ERROR]))
    return texts[WARN]
