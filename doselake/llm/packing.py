"""Documents packed into token sequences by vector best-fit.

A document is its ids and an end id; only one longer than a sequence is cut, its first
piece taking the remainder. A piece asks three capacities of a sequence: tokens, one
document, and attention cost (the square of its length). Pieces go, longest first, into
the open sequence that scores best among those with room under every constraint:

* ``norm``: the least weighted norm of what is left afterwards;
* ``dot``: the greatest weighted dot product of demand and room.

Demand depends on the length alone, so the choice is made for counts of lengths, not for
rows: a table of at most ``length`` counts gives the plan, in which sequences of equal
room are one state with a number of sequences. Rows then find their place in the plan by
length and number, in tasks, and no part of the table is packed apart from the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, text, tokens

LENGTH = 2048
END = 0
WEIGHTS = (1.0, 1 / 64, 1 / 64)  # of tokens, documents and attention cost

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; without a limit of its own, attention is that of one full piece."""

    tokens: int = LENGTH
    documents: int = LENGTH
    attention: int | None = None

    def vector(self) -> np.ndarray:
        cost = self.tokens**2 if self.attention is None else self.attention
        return np.array([self.tokens, self.documents, cost], np.int64)


@dataclass(frozen=True)
class Plan:
    """Runs of pieces of one length, in order: from ``rank`` on, ``each`` to a sequence."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces that are number ``rank`` of their length."""
        first = np.searchsorted(self.length, length)
        last = np.searchsorted(self.length, length, "right")
        while (wide := last - first > 1).any():  # the run of each: a binary search of ranks
            middle = (first + last) // 2
            right = wide & (self.rank[np.minimum(middle, len(self.rank) - 1)] <= rank)
            first, last = np.where(right, middle, first), np.where(wide & ~right, middle, last)
        nth = rank - self.rank[first]
        sequence = self.sequence[first] + nth // self.each[first]
        return sequence, self.offset[first] + nth % self.each[first] * length


class _Open:
    """Open sequences by their room; those of equal room are ranges of numbers."""

    def __init__(self, capacity: np.ndarray, weights: tuple[float, ...], rule: str):
        self.capacity, self.rule = capacity, rule
        self.scale = np.sqrt(np.array(weights)) / capacity
        self.room = np.zeros((0, 3), np.int64)
        self.ranges: list[list[list[int]]] = []
        self.row: dict[tuple, int] = {}
        self.made = 0

    def score(self, room: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Higher is better; sequences without room for the item have none."""
        left = room - item
        if self.rule == "norm":
            value = -np.square(left * self.scale).sum(axis=-1)
        else:
            value = (room * self.scale * (item * self.scale)).sum(axis=-1)
        return np.where((left >= 0).all(axis=-1), value, -np.inf)

    def add(self, room: np.ndarray, first: int, count: int) -> None:
        if room[0] <= 0 or room[1] <= 0 or room[2] <= 0:
            return
        key = tuple(room.tolist())
        if key not in self.row:
            self.row[key] = len(self.ranges)
            self.ranges.append([])
            self.room = np.vstack([self.room, room])
        self.ranges[self.row[key]].append([first, count])

    def compact(self) -> None:
        live = [i for i, ranges in enumerate(self.ranges) if ranges]
        if len(live) * 2 < len(self.ranges):
            self.room, self.ranges = self.room[live], [self.ranges[i] for i in live]
            self.row = {tuple(room): i for i, room in enumerate(self.room.tolist())}

    def best(self, item: np.ndarray) -> tuple[int | None, float]:
        """The state to take, and the score of the next best one."""
        if not self.ranges:
            return None, -np.inf
        scores = self.score(self.room, item)
        scores[[not ranges for ranges in self.ranges]] = -np.inf
        top = int(np.argmax(scores))
        if scores[top] == -np.inf:
            return None, -np.inf
        several = sum(count for _, count in self.ranges[top]) > 1
        rest = np.delete(scores, top).max(initial=-np.inf)
        return top, max(rest, scores[top]) if several else rest


def plan(
    counts: dict[int, int], capacity: Capacity, weights: tuple[float, ...] = WEIGHTS, rule: str = "norm"
) -> Plan:
    """The sequences for ``counts`` pieces of each length, as piece by piece best-fit gives them.

    A piece that alone exceeds a capacity has a sequence of its own.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule: {rule}")
    whole = capacity.vector()
    state, runs = _Open(whole, weights, rule), []
    for length in sorted(counts, reverse=True):
        item, rank, count = np.array([length, 1, length * length], np.int64), 0, counts[length]
        while rank < count:
            state.compact()
            top, rival = state.best(item)
            room = whole if top is None else state.room[top]
            left, each = room - item, 1
            while rank + each < count and state.score(left, item) >= rival and (left >= item).all():
                left, each = left - item, each + 1
            if top is None:
                first, free = state.made, 1 << 62
            else:
                first, free = state.ranges[top][-1]
            taken = min(free, (count - rank) // each)
            if top is None:
                state.made += taken
            else:
                state.ranges[top][-1] = [first + taken, free - taken]
                if taken == free:
                    state.ranges[top].pop()
            runs.append((length, rank, first, each, int(whole[0] - room[0])))
            state.add(left, first, taken)
            rank += taken * each
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=state.made)


_PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, part int, nth long"


def pieces(
    docs: DataFrame, length: int = LENGTH, vocabulary: str = tokens.JSON_VOCABULARY, with_ids: bool = False
) -> DataFrame:
    """A stored row per piece; ``nth`` counts pieces of a length within a ``part``."""
    shared = tokens.shared(docs.sparkSession, vocabulary)

    def run(batches: Batches) -> Batches:
        encoder = tokens.Encoder(shared.value)
        part, seen = TaskContext.get().partitionId(), [0] * (length + 1)
        for batch in text.slices(batches):
            rows = []
            for doc, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = np.append(encoder.ids(value), END).astype("<u4")
                cut = len(own) % length or length
                for piece, start in enumerate([0, *range(cut, len(own), length)]):
                    some = own[start : cut + piece * length].tobytes()
                    size = len(some) // 4
                    rows.append((doc, piece, start, size, zlib.crc32(some), some if with_ids else None, part, seen[size]))
                    seen[size] += 1
            names = [c.split()[0] for c in _PIECE.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return scratch.store(rows.mapInArrow(run, _PIECE))


def pack(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    weights: tuple[float, ...] = WEIGHTS,
    rule: str = "norm",
    vocabulary: str = tokens.JSON_VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """Per piece of (doc_id, text): doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    ``ids`` (little-endian, four bytes each) are null unless ``with_ids``. A null or empty
    text is one piece, its end id. Repeated rows are documents of their own, a null id is
    kept. Texts of any length are encoded whole. Other columns are ignored; an empty
    table has no pieces. Sequences are numbered from 0 without gaps.
    """
    found = pieces(docs, capacity.tokens, vocabulary, with_ids)
    sizes = scratch.store(found.groupBy("part", "length").agg(F.max("nth").alias("last")))
    counts = sizes.groupBy("length").agg(F.sum(F.col("last") + 1).alias("n")).collect()  # at most one a length
    made = plan({r["length"]: r["n"] for r in counts}, capacity, weights, rule)
    shared = docs.sparkSession.sparkContext.broadcast(made)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("last") + 1).over(earlier), F.lit(0)).alias("before")
    ranked = found.join(sizes.select("part", "length", before), ["part", "length"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", F.expr("before + nth").alias("sequence_id")
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "sequence_id"))
            sequence, offset = shared.value.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names, "offset"]
            )

    return ranked.mapInArrow(
        run,
        "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, sequence_id long, offset long",
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence of `pack` with ids: sequence_id, ids, and (doc_id, piece, start, offset, length) in order."""
    own = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(own)).alias("held"))
    return held.select(
        "sequence_id",
        F.expr("aggregate(held, cast('' as binary), (all, one) -> all || one.ids)").alias("ids"),
        F.expr("transform(held, x -> struct(x.doc_id, x.piece, x.start, x.offset, x.length))").alias("pieces"),
    )
