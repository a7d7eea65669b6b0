"""Keep one row per key: the latest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, newest: Column, rest: Sequence[str]) -> DataFrame:
    """``key`` and ``rest`` of the row with the highest ``newest`` per key.

    The rows of a key compete as structs led by ``newest``, so equal (or missing,
    which sort last) values are settled by the other columns and the choice does not
    depend on the order of the input. Being an aggregate, it is combined map-side:
    a key holding a third of all rows sends one row per map task, and the sort only
    looks at the key. A null key forms one group, like any other value.
    """
    version = F.struct(newest.alias("_newest"), *rest)
    return (
        df.select(key, version.alias("_version"))
        .groupBy(key)
        .agg(F.max("_version").alias("_version"))
        .select(key, *[F.col("_version")[c].alias(c) for c in rest])
    )
