"""The latest version per key, kept up to date month by month.

What is stored are contenders: the newest version of every key in every month, bucketed by
key. A reloaded month replaces its own contenders, so versions it no longer holds cannot
win, and older ones surface again. The winners are an aggregate over the bucketed table,
which needs no exchange; only a month that changes is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .latest import keep_latest

_NEWEST = "_newest"
ROWS_PER_BUCKET = 1_000_000  # a bucket is one task's sort


@dataclass(frozen=True)
class Contenders:
    """A bucketed table ``name`` below ``folder``; ``rest`` also settles ties, in its order.

    It is created with ``buckets``, or with more where they would hold more than
    ``per_bucket`` rows each.
    """

    spark: SparkSession
    name: str
    folder: str
    key: str
    month: str
    rest: Sequence[str]
    buckets: int = 64
    per_bucket: int = ROWS_PER_BUCKET

    def create(self, rows: DataFrame, newest: Column) -> None:
        """Store the contenders of all months of ``rows``."""
        buckets = max(self.buckets, -(-rows.count() // self.per_bucket))
        (
            self._best(rows, newest, buckets)
            .write.mode("overwrite")
            .format("parquet")
            .option("path", self.folder)
            .option("partitionOverwriteMode", "dynamic")  # of later inserts: other months stay
            .partitionBy(self.month)
            .bucketBy(buckets, self.key)
            .saveAsTable(self.name)
        )

    def replace(self, rows: DataFrame, newest: Column, months: Sequence[str] = ()) -> None:
        """Replace the months of ``rows``; ``months`` lists those that may have become empty."""
        present = {r[0] for r in rows.select(self.month).distinct().collect()} if months else set()
        stored = self.spark.table(self.name)
        best = self._best(rows, newest, self._buckets()).select(*stored.columns)
        best.write.insertInto(self.name, overwrite=True)
        for month in set(months) - present:
            self.spark.sql(
                f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self.month} = :month)", {"month": month}
            )

    def winners(self) -> DataFrame:
        """One row per key: the newest version of all months."""
        return keep_latest(self.spark.table(self.name), self.key, F.col(_NEWEST), list(self.rest))

    def _buckets(self) -> int:
        """How many buckets the stored table has."""
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        return int(about.where("col_name = 'Num Buckets'").first()["data_type"])

    def _best(self, rows: DataFrame, newest: Column, buckets: int) -> DataFrame:
        """The newest version per key and month, a task for each bucket.

        Versions are combined map-side before they move, so a key (or a missing one) that
        holds a third of the rows sends one row a month and task.
        """
        version = F.struct(newest.alias(_NEWEST), *self.rest)
        best = (
            rows.select(self.key, self.month, version.alias("_version"))
            .groupBy(self.key, self.month)
            .agg(F.max("_version").alias("_version"))
            .select(self.key, f"_version.{_NEWEST}", *[f"_version.{c}" for c in self.rest], self.month)
        )
        return best.repartition(buckets, self.key)
