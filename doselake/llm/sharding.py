"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The unit is a group of equal texts; its hash is its place on the ring, and the next
virtual node clockwise names its shard. No shard takes more than ``(1 + slack)`` times its
fair share of bytes: what meets a full shard continues clockwise to one with room.

The ring is walked over a bounded summary. Groups above a thousandth of a shard (at most
1,000 a shard) go one by one, heaviest first; the light rest is summed in `CELLS` arcs of
the ring, which go in ring order. Both tables are of proven size, so they are collected
for the walk and broadcast back. A group that alone outweighs a shard cannot stay whole
and is dealt row by row instead, whether its rows have ids, share them or have none.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .numbering import bucket_count, numbered

CELL_BITS = 16
CELLS = 1 << CELL_BITS
HEAVY_PER_SHARD = 1000
VIRTUAL_NODES = 128
SLACK = 0.0005


class Ring:
    """Places are signed 64-bit numbers; ``capacity`` bounds what a shard takes."""

    def __init__(self, shards: int, capacity: float, virtual_nodes: int = VIRTUAL_NODES):
        def place(shard: int, replica: int) -> int:
            digest = hashlib.blake2b(f"{shard}/{replica}".encode(), digest_size=8).digest()
            return int.from_bytes(digest, "big", signed=True)

        self.nodes = sorted((place(s, r), s) for s in range(shards) for r in range(virtual_nodes))
        self.places = [p for p, _ in self.nodes]
        self.capacity = capacity
        self.load = [0] * shards

    def put(self, place: int, size: int) -> int:
        """The first shard clockwise with room, or else the least loaded one."""
        start = bisect.bisect_left(self.places, place)
        passed: set[int] = set()
        for i in range(len(self.nodes)):
            shard = self.nodes[(start + i) % len(self.nodes)][1]
            if shard in passed:
                continue
            if self.load[shard] + size <= self.capacity:
                break
            passed.add(shard)
            if len(passed) == len(self.load):
                shard = min(range(len(self.load)), key=lambda s: (self.load[s], s))
                break
        self.load[shard] += size
        return shard


def shard(
    docs: DataFrame, shards: int = 8, slack: float = SLACK, doc_id: str = "doc_id", column: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1. The law is ``bytes``: shards are near equal
    in size, up to the heaviest group. ``slot`` numbers a shard's rows from 0 without gaps.
    ``grown_shard`` is null, as loads decide besides keys. A null text has no bytes and
    the checksum of an empty one, but is a group apart. Repeated rows share a shard, unless
    they outweigh one: then which row of such a group goes where follows its place in the table.
    Null ids are ids like others. Other columns are ignored.
    """
    text = F.col(column)
    rows = scratch.store(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.md5(text)).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total, fair = total or 0, (total or 0) / shards
    oversized = _heavier(rows.groupBy("group").agg(F.sum("size").alias("size")), fair)
    units = rows.withColumn(
        "unit",
        F.when(F.col("group").isin([g for g, _ in oversized]), F.xxhash64("group", "row")).otherwise(F.col("group")),
    )
    placed = _placed(units, shards, fair, fair * (1 + slack))
    position = F.xxhash64("doc_id", "unit")
    buckets = bucket_count((count or 0) // shards)
    out = numbered(
        placed.withColumn("_position", position),
        ["shard"],
        F.pmod(F.col("_position"), F.lit(buckets)),
        [F.col("_position"), F.col("doc_id"), F.col("unit"), F.col("size")],
        "slot",
    )
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _heavier(groups: DataFrame, least: float) -> list[tuple[int, int]]:
    """Groups above ``least`` bytes: fewer than all bytes divided by it."""
    return [tuple(r) for r in groups.where(F.col("size") > least).collect()]


def _placed(units: DataFrame, shards: int, fair: float, capacity: float) -> DataFrame:
    spark = units.sparkSession
    sums = scratch.store(units.groupBy(F.col("unit").alias("group")).agg(F.sum("size").alias("size")))
    light_limit = fair / HEAVY_PER_SHARD
    cell = F.shiftrightunsigned(F.col("group"), 64 - CELL_BITS).cast("int")
    cells = (
        sums.where(F.col("size") <= light_limit).groupBy(cell.alias("cell")).agg(F.sum("size").alias("size")).collect()
    )
    ring = Ring(shards, capacity)
    heavy = sorted(_heavier(sums, light_limit), key=lambda g: (-g[1], g[0]))
    heavy = [(g, ring.put(g, size)) for g, size in heavy]
    loads = {c: size for c, size in cells}
    half = CELLS // 2  # cells are unsigned, places signed: the ring starts at cell ``half``
    light = []
    for at in range(CELLS):
        c = (at + half) % CELLS
        if c in loads:
            light.append((c, ring.put((at - half) << (64 - CELL_BITS), loads[c])))

    heavy = F.broadcast(spark.createDataFrame(heavy, "unit long, _heavy int"))
    light = F.broadcast(spark.createDataFrame(light, "_cell int, _light int"))
    found = units.join(heavy, "unit", "left").join(
        light, F.shiftrightunsigned(F.col("unit"), 64 - CELL_BITS).cast("int") == F.col("_cell"), "left"
    )
    return found.withColumn("shard", F.coalesce("_heavy", "_light")).drop("_heavy", "_light", "_cell")
