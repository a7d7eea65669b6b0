"""Comparing two tables by digests of their parts (Q9).

Rows are dealt to parts by a hash of their keys, and a part's digest is the number of its
rows and the sum of their hashes, which does not depend on their order. Only digests are
shuffled, at most `FANOUT` squared a task and side, and only parts whose digests differ
are opened and compared row by row. Parts form a tree of two levels: where whole branches
agree, their parts are not looked at either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 256  # branches, and parts of a branch


def _part(keys: Sequence[str], fanout: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(fanout * fanout))


def digests(df: DataFrame, keys: Sequence[str], values: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """(part, rows, digest) of the parts that have rows; two hashes make a digest of 128 bits."""
    row = [*keys, *values]
    # Sums of decimals, which neither wrap nor depend on the order.
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64(*row), F.xxhash64(F.lit(1), *row))]
    parts = df.groupBy(_part(keys, fanout).alias("part")).agg(F.count("*").alias("rows"), *[
        s.alias(f"sum_{i}") for i, s in enumerate(sums)
    ])
    return parts.select("part", "rows", F.concat_ws("/", "sum_0", "sum_1").alias("digest"))


def differing_parts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], fanout: int = FANOUT
) -> DataFrame:
    """Parts whose digests differ, found from the branches down."""
    sides = [digests(df, keys, values, fanout) for df in (left, right)]
    branch = F.floor(F.col("part") / fanout).alias("branch")
    joined = None
    for name, side in zip(("l", "r"), sides, strict=True):
        held = side.groupBy(branch).agg(F.map_from_entries(F.collect_list(F.struct("part", "digest"))).alias(name))
        joined = held if joined is None else joined.join(held, "branch", "full_outer")
    empty = F.expr("map()").cast("map<bigint,string>")
    both = joined.select(*[F.coalesce(c, empty).alias(c) for c in ("l", "r")])
    unlike = both.where(F.array_sort(F.map_entries("l")) != F.array_sort(F.map_entries("r")))
    parts = F.array_union(F.map_keys("l"), F.map_keys("r"))
    return (
        unlike.select("l", "r", F.explode(parts).alias("part"))
        .where("NOT try_element_at(l, part) <=> try_element_at(r, part)")
        .select("part")
    )


def differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], fanout: int = FANOUT
) -> DataFrame:
    """Rows of one side that the other lacks: keys, values, and ``lado`` with ``vezes`` too many.

    Repeated rows count as often as they are there; nulls equal each other.
    """
    parts = differing_parts(left, right, keys, values, fanout).withColumnRenamed("part", "_part")
    opened = []
    for side, sign in ((left, 1), (right, -1)):
        rows = side.select(*keys, *values, _part(keys, fanout).alias("_part"), F.lit(sign).alias("_sign"))
        # At most fanout squared numbers, so the rows stay where they are.
        opened.append(rows.join(F.broadcast(parts), "_part", "left_semi"))
    return (
        opened[0].unionByName(opened[1])
        .groupBy(*keys, *values)
        .agg(F.sum("_sign").alias("_more"))
        .where("_more <> 0")
        .select(
            *keys,
            *values,
            F.when(F.col("_more") > 0, "esquerda").otherwise("direita").alias("lado"),
            F.abs("_more").alias("vezes"),
        )
    )
