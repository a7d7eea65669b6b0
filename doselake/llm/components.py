"""Connected components of an undirected graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has whole numbers ``a`` and ``b``. Each round links every node's larger
    neighbours to its smallest one, then every node's smaller neighbours likewise, until
    all edges point at a smallest node; long chains take logarithmically many rounds.
    Minima are combined map-side, so a node with many neighbours sends one row a task.
    Nulls and loops are no edges; repeated edges count once; no edges give no rows.
    """
    edges = scratch.store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    )
    while not _stars(edges):
        edges = scratch.store(_to_smallest_below(_to_smallest_around(edges)))
    ends = edges.union(edges.select("b", "b")).toDF("node", "component")
    return ends.groupBy("node").agg(F.first("component").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("below")).union(
        edges.select("b", F.lit(None).cast("long"))
    )
    seen = ends.groupBy("node").agg(
        F.min("below").alias("least"), F.max("below").alias("most"), F.expr("bool_or(below is null)").alias("under")
    )
    return seen.where("least < most or (under and least is not null)").count() == 0


def _to_smallest_around(edges: DataFrame) -> DataFrame:
    around = edges.union(edges.select("b", "a"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("least").alias("b"))


def _to_smallest_below(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(least, "a").where("b <> least")
    moved = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
