"""Hard negatives: exact score windows over a multiway hyperplane tree.

Components become ``floor(256 * x)``, scores are their inner products. A node of the tree
has several split points, spread over the sample it is fitted on; a vector belongs to the
nearest one (that is, to a side of each hyperplane between two), and so on down to a leaf.
Every split point keeps, over all rows, the least and the greatest distance to each of its
siblings' subtrees, and subtrees keep theirs of vector lengths.

A window of scores around a query is an annulus of distances: from the range of lengths in
a subtree follow its radii. A split point that knows the query's distance then tells which
siblings can hold vectors in the annulus; the others are left out. Leaves are scored
exactly, so the tree decides about work only. A search looks at the query's own part of
its leaf first, which narrows the window to what can still enter the best.

The split points are fitted on a bounded sample (`SAMPLE` rows); all rows are indexed. A
leaf is held in parts of about `PART_ROWS` rows: many equal vectors make many parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

SAMPLE = 8192
ARITY = 12
LEAF_ROWS = 512  # of the sample's share; below it a node is not split
PART_ROWS = 4096
QUERIES_AT_ONCE = 256
_SAFE = 2.0**53  # sums of whole doubles below it are exact

Batches = Iterator[pa.RecordBatch]


@dataclass
class Tree:
    """Split points by node; children are nodes or, as ~number, leaves."""

    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Leaf of each vector, and (node, rows, distances to its points) on the way."""
        leaf, steps = np.zeros(len(vectors), np.int64), []
        waiting = [(0, np.arange(len(vectors)))] if self.points else []
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            far = distances(vectors[rows], self.points[node])
            steps.append((node, rows, far))
            nearest = far.argmin(axis=1)
            for i, child in enumerate(self.children[node]):
                own = rows[nearest == i]
                if child < 0:
                    leaf[own] = ~child
                else:
                    waiting.append((child, own))
        return leaf, steps


def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(axis=1)[:, None] + (points**2).sum(axis=1) - 2 * (vectors @ points.T)
    return np.sqrt(np.maximum(square, 0))


def fit(sample: np.ndarray, rows: int, arity: int = ARITY, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree whose leaves hold about ``leaf_rows`` of ``rows``, as far as the sample tells them apart."""
    tree = Tree()
    share = rows / max(len(sample), 1)

    def grow(own: np.ndarray) -> int:
        points = _spread(own, arity) if len(own) * share > leaf_rows else own[:0]
        if len(points) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        node = len(tree.points)
        tree.points.append(points)
        tree.children.append([])
        nearest = distances(own, points).argmin(axis=1)
        tree.children[node] = [grow(own[nearest == i]) for i in range(len(points))]
        return node

    grow(sample)
    return tree


def _spread(own: np.ndarray, arity: int) -> np.ndarray:
    """Points far from each other: each the farthest from those before it."""
    if len(own) < 2:
        return own[:0]
    chosen, least = [0], distances(own, own[:1])[:, 0]
    while len(chosen) < arity and least.max() > 1e-6 * (1 + least.max()):
        chosen.append(int(least.argmax()))
        np.minimum(least, distances(own, own[chosen[-1:]])[:, 0], out=least)
    return own[chosen]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole doubles; short ones end in zeros."""
    size = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), np.float64)
    if (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond doubles' whole numbers, as Python's."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if bound < _SAFE:
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in side], object) for side in (left, right)]
    return whole[0].reshape(left.shape) @ whole[1].reshape(right.shape).T


@dataclass
class Index:
    """All rows (row, vec_id, label, vector, leaf, part), the tree and its ranges."""

    rows: DataFrame
    width: int
    shared: Broadcast


@dataclass
class _Known:
    """What a search has in every task."""

    tree: Tree
    near: dict[int, np.ndarray]  # by node: least distances of points (rows) to subtrees
    far: dict[int, np.ndarray]
    short: dict[int, np.ndarray]  # by node: least and greatest squared lengths in subtrees
    long: dict[int, np.ndarray]
    parts: np.ndarray

    def alive(self, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) where a row may score within ``low`` .. ``high``."""
        if not self.tree.points:
            yield 0, np.arange(len(vectors))
            return
        square = (vectors**2).sum(axis=1)[:, None]
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, some = waiting.pop()
            far = distances(vectors[some], self.tree.points[node])
            size = np.sqrt(max(square[some].max(), self.long[node].max(), 0))
            slack = 1e-6 * (1 + size)  # of rounding
            inner = np.sqrt(np.maximum(square[some] + self.short[node] - 2 * high[some, None], 0)) - slack
            outer = np.sqrt(np.maximum(square[some] + self.long[node] - 2 * low[some, None], 0)) + slack
            reach = square[some] + self.long[node] - 2 * low[some, None] >= -slack * size
            for i, child in enumerate(self.tree.children[node]):
                least, most = self.near[node][:, i], self.far[node][:, i]
                meets = (least <= far + outer[:, i, None]) & (most >= far - outer[:, i, None])
                meets &= most >= inner[:, i, None] - far
                own = some[meets.all(axis=1) & reach[:, i]]
                if not len(own):
                    continue
                if child < 0:
                    yield ~child, own
                else:
                    waiting.append((child, own))


_ROW = "row long, vec_id long, label int, vector array<double>"


def prepared(vectors: DataFrame, relabel_every: int = 0, labels: int = 10) -> DataFrame:
    """Stored rows that take part: row, vec_id, label, whole components."""
    whole = F.expr("transform(embedding, x -> double(x))")
    usable = F.expr("label is not null and forall(vector, x -> x is not null and abs(x) < double('Infinity'))")
    label = F.col("label").cast("int")
    if relabel_every:
        turned = F.expr(f"coalesce(vec_id % {relabel_every} = 0, false)")
        label = F.when(turned, (label + 1) % labels).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.withColumn("vector", whole).where(usable)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            column = batch.column("vector")
            whole = np.floor(256.0 * np.asarray(column.flatten(), np.float64))
            ends = np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths()))])
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(whole))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], made], names=batch.schema.names)

    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), "vector")
    return scratch.store(rows.mapInArrow(run, _ROW))


def build(rows: DataFrame, sample: int = SAMPLE, part_rows: int = PART_ROWS, leaf_rows: int = LEAF_ROWS) -> Index:
    """Fit on about ``sample`` rows, drawn by hash; then place all rows and take their ranges."""
    count, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(width or 0, 1)
    share = min(1.0, sample / max(count, 1))
    chosen = rows.where(F.pmod(F.xxhash64("vec_id", "row"), F.lit(1 << 40)) < int(share * (1 << 40)))
    chosen = chosen.select("row", "vector").toArrow().sort_by("row").column("vector").combine_chunks()
    tree = fit(matrix(chosen, width), count, leaf_rows=leaf_rows)

    def place(batches: Batches) -> Batches:
        for batch in batches:
            leaf, _ = tree.route(matrix(batch.column("vector"), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    def measure(batches: Batches) -> Batches:
        found: dict[tuple[int, int, int], list[float]] = {}
        for batch in batches:
            vectors = matrix(batch.column("vector"), width)
            square = (vectors**2).sum(axis=1)
            for node, own, far in tree.route(vectors)[1]:
                nearest = far.argmin(axis=1)
                for j in np.unique(nearest):
                    some = nearest == j
                    measured = [*zip(far[some].min(axis=0), far[some].max(axis=0), strict=True)]
                    measured.append((square[own[some]].min(), square[own[some]].max()))
                    for i, (least, most) in enumerate(measured):
                        key = (node, i, int(j))
                        old = found.get(key, [least, most])
                        found[key] = [min(old[0], least), max(old[1], most)]
        keys = np.array([*found], np.int64).reshape(-1, 3)
        ends = np.array([*found.values()], np.float64).reshape(-1, 2)
        columns = [pa.array(c) for c in (*keys.T, *ends.T)]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "point", "child", "least", "most"])

    placed = scratch.store(rows.mapInArrow(place, f"{_ROW}, leaf long"))
    ranges = placed.drop("leaf").mapInArrow(measure, "node long, point long, child long, least double, most double")
    ranges = ranges.groupBy("node", "point", "child").agg(F.min("least"), F.max("most")).collect()
    near, far, short, long = {}, {}, {}, {}
    for node, points in enumerate(tree.points):
        k = len(points)
        # A subtree without rows is met by nothing.
        near[node], far[node] = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        short[node], long[node] = np.full(k, 0.0), np.full(k, -np.inf)
    for node, i, j, least, most in ranges:
        if i == len(tree.points[node]):
            short[node][j], long[node][j] = least, most
        else:
            near[node][i, j], far[node][i, j] = least, most
    sizes = dict(placed.groupBy("leaf").count().collect())
    parts = np.array([max(1, -(-sizes.get(leaf, 0) // part_rows)) for leaf in range(max(tree.leaves, 1))])
    known = _Known(tree, near, far, short, long, parts)
    count_of = F.element_at(F.lit(parts.tolist()), F.col("leaf").cast("int") + 1)
    part = F.pmod(F.xxhash64("row"), count_of).cast("long")
    return Index(placed.withColumn("part", part), width, rows.sparkSession.sparkContext.broadcast(known))


_QUERY = "row long, label int, vector array<double>, low array<long>, high array<long>"
ANY = (-(1 << 63), (1 << 63) - 1)


def _round(index: Index, sent: DataFrame, same: bool, count: int) -> DataFrame:
    """Best ``count`` rows in each window of the queries among the parts these are sent to.

    ``sent``: queries with ``leaf`` and ``part``. Result: row, nth (of the window, from 0),
    score, vec_id, found (the found row), rank.
    """
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    wanted = sent.select("leaf", "part").distinct()
    held = index.rows.select("leaf", "part", F.lit(0).alias("role"), "row", "label", "vector", "vec_id", *none)
    asked = sent.select(
        "leaf", "part", F.lit(1), "row", "label", "vector", F.lit(None).cast("long"), "low", "high"
    )
    both = held.join(wanted, ["leaf", "part"], "left_semi").union(asked)
    both = both.repartition("leaf", "part").sortWithinPartitions("leaf", "part", "role")
    width = index.width

    def run(batches: Batches) -> Batches:
        key, kept, ready = None, [], None
        for batch in batches:
            leaf, part, role = (batch.column(c).to_numpy() for c in ("leaf", "part", "role"))
            change = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0)) + 1
            for first, last in zip([0, *change], [*change, len(leaf)], strict=True):
                some = batch.slice(first, last - first)
                if (leaf[first], part[first]) != key:
                    key, kept, ready = (leaf[first], part[first]), [], None
                if role[first] == 0:
                    kept.append(some)
                    continue
                if ready is None:
                    ready = _Part(kept, width)
                for at in range(0, some.num_rows, QUERIES_AT_ONCE):
                    yield ready.search(some.slice(at, QUERIES_AT_ONCE), same, count)

    found = both.mapInArrow(run, "row long, nth int, score long, vec_id long, found long")
    order = Window.partitionBy("row", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


class _Part:
    """The rows of one part of a leaf, in the order that settles ties."""

    def __init__(self, batches: list[pa.RecordBatch], width: int):
        table = pa.Table.from_batches(batches).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        table = table.combine_chunks()
        self.row, self.label = (table.column(c).to_numpy() for c in ("row", "label"))
        self.vec_id = table.column("vec_id").combine_chunks()
        self.vectors = matrix(table.column("vector").combine_chunks(), width)
        self.width = width

    def search(self, queries: pa.RecordBatch, same: bool, count: int) -> pa.RecordBatch:
        score = scores(matrix(queries.column("vector"), self.width), self.vectors)
        labels = queries.column("label").to_numpy()
        ok = (self.label == labels[:, None]) if same else (self.label != labels[:, None])
        rows, nths, values, found = [], [], [], []
        columns = (queries.column(c).to_pylist() for c in ("row", "low", "high"))
        for i, (row, lows, highs) in enumerate(zip(*columns, strict=True)):
            at = np.flatnonzero(ok[i] & (score[i] >= min(lows)) & (score[i] <= max(highs)) & (self.row != row))
            if not len(at):
                continue
            falling = at[np.argsort(-score[i, at], kind="stable")]
            own = score[i, falling]
            for nth, (low, high) in enumerate(zip(lows, highs, strict=True)):
                first = int(np.searchsorted(-own, -high))
                some = falling[first : first + count][own[first : first + count] >= low]
                rows += [row] * len(some)
                nths += [nth] * len(some)
                values += score[i, some].tolist()
                found += some.tolist()
        where = np.array(found, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int64()), pa.array(nths, pa.int32()), pa.array(values, pa.int64()),
                self.vec_id.take(pa.array(where)), pa.array(self.row[where], pa.int64()),
            ],
            names=["row", "nth", "score", "vec_id", "found"],
        )


def search(index: Index, queries: DataFrame, same: bool, count: int) -> DataFrame:
    """The ``count`` best rows of equal (or of another) label with a score in each window.

    ``queries``: row, label, vector, and arrays low, high of one window each; ``row`` is the
    indexed row that asks, which is not found itself. Result: row, nth (of the window, from
    0), rank (from 1), score, vec_id, found.
    """
    own = queries.join(index.rows.select("row", "leaf", "part"), "row")
    first = _round(index, own, same, count).where(f"rank = {count}")
    least = first.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("nth", "score"))).alias("least"))
    nearer = "transform(low, (x, i) -> greatest(x, try_element_at(least, i)))"
    narrowed = queries.join(least, "row", "left").withColumn("low", F.expr(nearer)).drop("least")
    shared, width = index.shared, index.width

    def spread(batches: Batches) -> Batches:
        known = shared.value
        for batch in batches:
            low = np.array([min(x) for x in batch.column("low").to_pylist()], np.float64)
            high = np.array([max(x) for x in batch.column("high").to_pylist()], np.float64)
            for leaf, some in known.alive(matrix(batch.column("vector"), width), low, high):
                sent = batch.take(pa.array(some))
                for part in range(known.parts[leaf]):
                    ends = [pa.array(np.full(len(some), x, np.int64)) for x in (leaf, part)]
                    yield pa.RecordBatch.from_arrays([*sent.columns, *ends], names=[*sent.schema.names, "leaf", "part"])

    columns = [c.split()[0] for c in _QUERY.split(", ")]
    sent = scratch.store(narrowed.select(columns).mapInArrow(spread, f"{_QUERY}, leaf long, part long"))
    return scratch.store(_round(index, sent, same, count))


def hard_negatives(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    relabel_every: int = 0,
    leaf_rows: int = LEAF_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of (vec_id, embedding, label).

    Every row whose id is divisible by ``every`` is an anchor. Its positives are its best
    rows of the same label; a positive's negatives are the best of other labels that score
    ``low`` to ``high`` percent of it. Ties go to the smaller id (null last). Rows with a null
    label or vector or a component that is null or not finite take no part; shorter vectors
    end in zeros. Repeated rows are rows of their own; a row without an id can be found but
    is no anchor. Scores must fit 64 bits. Other columns are ignored; an empty table has no rows.
    """
    rows = prepared(vectors, relabel_every)
    index = build(rows, part_rows=part_rows, leaf_rows=leaf_rows)
    anchors = rows.where(F.col("vec_id") % every == 0)
    bounds = [F.array(F.lit(x)).alias(c) for c, x in zip(("low", "high"), ANY, strict=True)]
    best = search(index, anchors.select("row", "label", "vector", *bounds), True, positives)
    share = "cast({}(cast(score as decimal(20)) * {} / 100) as long)"
    windows = best.select("row", "rank", F.expr(share.format("ceil", low)).alias("low"), F.expr(share.format("floor", high)).alias("high"))
    windows = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("w"))
    asked = anchors.join(windows, "row").select("row", "label", "vector", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    found = search(index, asked, False, negatives).select(
        "row", (F.col("nth") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    pairs = best.select("row", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select("row", F.col("vec_id").alias("anchor_id"))
    return named.join(pairs, "row").join(found, ["row", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
