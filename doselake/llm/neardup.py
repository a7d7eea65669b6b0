"""Near-duplicates: MinHash coordinates posted to an inverted index, confirmed on full sets.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased); with
fewer words, the whole sequence is its one shingle; without words it is empty. Two
documents are linked if ``100 * intersection >= similarity * union``.

A signature has `COORDINATES` minima. Documents are posted under (coordinate, value), and
a pair qualifies with at least `MATCHES` equal coordinates, which at a similarity of 0.8
fails once in 800,000 pairs. Every document leaves out its ``MATCHES - 1`` postings with
the longest lists (prefix filtering by one order of all postings): a qualifying pair still
meets in a list, while a passage that many documents share no longer makes one.

The work stays linear where many documents are alike:

* equal sets are one node;
* every node is compared with one leader, the best connected node of the list it meets
  most often, and what that confirms is contracted. Then other leaders are tried, drawn
  from the lists that still hold several components, `DRAWS` at once, until a round joins
  next to nothing; a round contracts the components it joined, not all links anew;
* afterwards only pairs across components count (skip merging): lists inside one component
  vanish, and in the others only nodes outside the commonest component (strangers) are
  compared with the rest;
* these comparisons are no rows: a list is cut into cells of at most `CELL` nodes a side,
  a task counts the equal coordinates of a cell, and the node pairs that qualify leave it
  as one array a node. A pair is taken from the first list in which it meets;
* before it leaves, a pair is tested on a longer signature: the least shingle of each of
  `BINS` ranges of hashes, a byte each. At a similarity of 0.8 it fails the test once in
  some three million pairs, and below 0.66 it nearly always does.

What stays quadratic is the comparing inside tasks, for strangers of one list, and the
pairs between 0.66 and the similarity that no chain of links joins.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, text
from .components import components

COORDINATES = 32
MATCHES = 14
CELL = 4096  # nodes of a list that are compared with as many at once
BINS = 256
DRAWS = 4  # other leaders that a node is compared with in a round
WORTH = 100  # pairs that a round may try for each link, or it is the last
DEVIATIONS = 5  # below its mean that a linked pair's equal bins may lie
FILTER_WORDS = 1 << 20  # of 64 bits, 8 MB at most
BLOCK_SHINGLES = 1 << 18  # in the sets of one side that a task holds, or one set
_SHINGLES_AT_ONCE = 4096
_NODES_AT_ONCE = 256
_PAIRS_AT_ONCE = 1 << 15

_RNG = np.random.default_rng(77)
_FLIP = _RNG.integers(0, 1 << 63, (COORDINATES, 1), dtype=np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, (COORDINATES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

Batches = Iterator[pa.RecordBatch]


def _distinct(values: np.ndarray) -> np.ndarray:
    if len(values) < 2:
        return values
    values = np.sort(values)
    fresh = np.empty(len(values), bool)
    fresh[0] = True
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    data, offsets = text.flat(batch.column("text"))
    words, rows = text.word_hashes(text.lower(data), offsets)
    for first, last in zip(rows[:-1], rows[1:], strict=True):
        yield _distinct(text.shingle_hashes(words[first:last], size))


def _signature(members: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(members), _SHINGLES_AT_ONCE):
        part = members[None, first : first + _SHINGLES_AT_ONCE]
        np.minimum(least, ((part ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return least.astype(np.uint32).view(np.int32)


def _least_of_bins(members: np.ndarray) -> np.ndarray:
    """A byte of the least member of each range of hashes, 0 where it has none; eight to a number."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(56)
    at = np.searchsorted(members, edges)
    ends = np.append(at[1:], len(members))
    least = members[np.minimum(at, len(members) - 1)] % np.uint64(255) + np.uint64(1)
    return np.where(at < ends, least, 0).astype(np.uint8).view(np.int64)


def _alike(left: np.ndarray, right: np.ndarray, similarity: int) -> np.ndarray:
    """Whether rows of bins may be those of similar sets."""
    filled = ((left | right) > 0).sum(axis=-1)
    equal = ((left == right) & (left > 0)).sum(axis=-1)
    share = similarity / 100
    return equal >= share * filled - DEVIATIONS * np.sqrt(share * (1 - share) * filled)


def _may_be_alike(left: str, right: str, similarity: int):
    """`_alike` of two columns of bins: bins that differ, and filled ones, are bytes that are not 0."""
    share = similarity / 100
    filled, apart = _nonzero_bytes(left, right, "|"), _nonzero_bytes(left, right, "^")
    return filled - apart >= share * filled - DEVIATIONS * F.sqrt(share * (1 - share) * filled)


def _nonzero_bytes(left: str, right: str, operator: str):
    """How many bytes are not 0 in two columns of longs put together."""
    numbers = f"zip_with({left}, {right}, (l, r) -> l {operator} r)"
    for shift in (4, 2, 1):  # the bits of a byte are gathered in its lowest
        numbers = f"transform({numbers}, v -> v | shiftrightunsigned(v, {shift}))"
    return F.expr(f"aggregate({numbers}, 0, (s, v) -> s + bit_count(v & {0x0101010101010101}L))")


def signatures(docs: DataFrame, words: int, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, class (a 128-bit digest of its set, null if empty), sig, bins."""

    def run(batches: Batches) -> Batches:
        for batch in text.slices(batches):
            count, digest, sig, bins = [], [], [], []
            for members in _sets(batch, words):
                count.append(len(members))
                known = len(members) > 0
                digest.append(
                    hashlib.blake2b(members.tobytes(), digest_size=16).digest() if known else None
                )
                sig.append(_signature(members) if known else None)
                bins.append(_least_of_bins(members) if known else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(count, pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(sig, pa.list_(pa.int32())),
                    pa.array(bins, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "sig", "bins"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, class binary, sig array<int>, bins array<long>"
    )


def _similar_sizes(a: str, b: str, similarity: int):
    return F.expr(f"100 * least({a}, {b}) >= {similarity} * greatest({a}, {b})")


def _enough_matches(left: str, right: str):
    """Counts equal coordinates of two signatures."""
    same = " + ".join(f"int({left}[{i}] = {right}[{i}])" for i in range(COORDINATES))
    return F.expr(f"({same}) >= {MATCHES}")


def _match(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) whose sizes and whole signatures allow the similarity; they lie by b."""
    for side in ("b", "a"):
        own = nodes.select(
            F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "sig", "bins")]
        )
        pairs = pairs.join(own, side)
    close = _similar_sizes("n_a", "n_b", similarity) & _enough_matches("sig_a", "sig_b")
    return pairs.where(close & _may_be_alike("bins_a", "bins_b", similarity)).select("a", "b")


def _having(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` less most rows whose id is not in ``ids`` (column ``node``, stored, may repeat).

    A bit table of at most `FILTER_WORDS` words is broadcast, so texts that no pair needs
    are dropped before the shuffle; beyond millions of ids it lets more and more through.
    """
    words = 1 << min(FILTER_WORDS.bit_length() - 1, max(10, ids.count().bit_length()))
    place = f"xxhash64({{}}) & {words - 1}"
    bit = "shiftleft(1L, int(xxhash64({}, 1) & 63))"
    filled = ids.select(
        F.expr(place.format("node")).alias("_word"), F.expr(bit.format("node")).alias("_bit")
    )
    filled = filled.groupBy("_word").agg(F.expr("bit_or(_bit)").alias("_bits"))
    there = docs.withColumn("_word", F.expr(place.format("doc_id"))).join(F.broadcast(filled), "_word")
    return there.where(f"_bits & {bit.format('doc_id')} <> 0").drop("_word", "_bits")


def _blocks(labels: DataFrame) -> DataFrame:
    """(node, block) of rows (node, label, n): a label's nodes in parts of `BLOCK_SHINGLES`."""
    parts = labels.groupBy("label").agg(
        F.expr(f"cast(ceil(sum(n) / {BLOCK_SHINGLES}) as int)").alias("parts")
    )
    part = "xxhash64(label, pmod(xxhash64(node), parts))"
    return labels.join(parts, "label").select("node", F.expr(part).alias("block"))


def confirm(dealt: DataFrame, wanted: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """Links (a, b) among ``dealt`` (key, a, partners): sets that are similar enough.

    ``wanted`` are the (key, node) whose texts the pairs of a key need; a task holds the
    sets of one key. Pairs that other links of a key already join are skipped.
    """
    texts = _having(docs, wanted.select("node")).select(F.col("doc_id").alias("node"), "text")
    none = F.lit(None).cast("array<long>")
    rows = wanted.distinct().join(texts, "node").select(
        "key", F.lit(0).alias("role"), F.col("node").alias("a"), none.alias("partners"), "text"
    )
    rows = rows.union(dealt.select("key", F.lit(1), "a", "partners", F.lit(None).cast("string")))

    def run(batches: Batches) -> Batches:
        current, held, joined = None, {}, {}
        for batch in text.slices(batches):
            found_a, found_b = [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "role", "a", "partners"))
            for key, role, a, partners, members in zip(*columns, _sets(batch, words), strict=True):
                if key != current:
                    current, held, joined = key, {}, {}
                if role == 0:
                    if len(members):
                        held.setdefault(a, []).append(members)
                    continue
                apart = [b for b in partners if b in held and _root(joined, a) != _root(joined, b)]
                for b in _linked(held.get(a, ()), apart, held, similarity):
                    mine, other = _root(joined, a), _root(joined, b)
                    if mine != other:
                        joined[mine] = other
                        found_a.append(a)
                        found_b.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"]
            )

    sent = rows.repartition("key").sortWithinPartitions("key", "role")
    return sent.mapInArrow(run, "a long, b long")


def _root(joined: dict[int, int], node: int) -> int:
    while node in joined:
        joined[node] = joined.get(joined[node], joined[node])
        node = joined[node]
    return node


def _linked(
    lefts: list[np.ndarray], partners: list[int], held: dict[int, list[np.ndarray]], similarity: int
) -> list[int]:
    """The partners of which a set is similar enough to one of ``lefts`` (sorted and distinct)."""
    owners = [b for b in partners for _ in held[b]]
    if not owners or not lefts:
        return []
    rights = [members for b in partners for members in held[b]]
    sizes = np.array([len(r) for r in rights])
    everything = np.concatenate(rights)
    found = np.zeros(len(rights), bool)
    for left in lefts:
        at = np.minimum(np.searchsorted(left, everything), len(left) - 1)
        both = np.add.reduceat(left[at] == everything, np.cumsum(sizes) - sizes, dtype=np.int64)
        found |= 100 * both >= similarity * (len(left) + sizes - both)
    return list(dict.fromkeys(b for b, yes in zip(owners, found, strict=True) if yes))


def groups(docs: DataFrame, found: DataFrame, words: int, similarity: int) -> DataFrame:
    """(node, component) of the documents that confirmed links connect; ``found`` are `signatures`.

    Copies are represented by the smallest id of their class. Not every pair is tried:
    pairs whose ends other links already join are skipped.
    """
    nodes = scratch.store(
        found.where("class is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("node"), *[F.first(c).alias(n) for c, n in (("n_shingles", "n"), ("sig", "sig"), ("bins", "bins"))])
        .where("node is not null")
        .select("node", "n", "sig", "bins")
    )
    members = scratch.store(_members(nodes))
    pairs = scratch.store(_match(_leaders(members), nodes, similarity))
    labels = scratch.store(
        members.groupBy("node").agg(F.first("n").alias("n")).join(pairs.select(F.col("b").alias("node"), "a"), "node", "left")
        .select("node", "n", F.coalesce("a", "node").alias("label"))
    )
    blocks = scratch.store(_blocks(labels))
    homes = components(scratch.store(_confirmed(pairs, blocks, docs, words, similarity)))
    members = scratch.store(_apart(members, homes))
    for draw in itertools.count(1, DRAWS):
        leaders = _other_leaders(members, range(draw, draw + DRAWS))
        tried = scratch.store(_match(leaders, nodes, similarity))
        joined = scratch.store(_confirmed(tried, blocks, docs, words, similarity))
        found = joined.count()
        if not found:
            break
        homes = _merged(homes, joined)
        members = scratch.store(_apart(members.drop("home"), homes))
        if found * WORTH < tried.count():
            break
    across = scratch.store(_across(members, nodes, blocks, similarity))
    wanted = across.where("partners is null").select("key", F.col("a").alias("node"))
    dealt = across.where("partners is not null")
    return _merged(homes, scratch.store(confirm(dealt, wanted, docs, words, similarity)))


def _merged(homes: DataFrame, joined: DataFrame) -> DataFrame:
    """``homes`` (node, component) after more links (a, b): only their components are joined anew."""
    for side in ("a", "b"):
        own = homes.select(F.col("node").alias(side), F.col("component").alias("home"))
        joined = joined.join(own, side, "left").withColumn(side, F.coalesce("home", side)).drop("home")
    moved = components(joined)
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
    rest = homes.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return scratch.store(rest.union(moved).groupBy("node").agg(F.first("component").alias("component")))


def _confirmed(pairs: DataFrame, blocks: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The links among single pairs (a, b), each confirmed where the block of b is held."""
    own = blocks.select(F.col("node").alias("b"), F.col("block").alias("key"))
    dealt = scratch.store(pairs.join(own, "b").select("key", "a", F.array("b").alias("partners")))
    wanted = dealt.select("key", F.col("a").alias("node")).union(dealt.select("key", F.col("partners")[0]))
    return confirm(dealt, wanted, docs, words, similarity)


def _other_leaders(rows: DataFrame, draws: range) -> DataFrame:
    """For nodes (b) of lists with several components, nodes (a) of other ones, one a draw.

    Each list draws a node, and for the members of its component one of another component;
    a node takes the one it meets most often. Of the components with the greatest and the
    least hash one is another, so that a list is one aggregate.
    """
    drawn = []
    for draw in draws:
        one = F.struct(F.xxhash64("node", F.lit(draw)).alias("lot"), F.col("node").alias("a"), "home")
        of_home = F.struct(F.xxhash64("home", F.lit(draw)).alias("hash"), one.alias("drawn"))
        drawn.append(
            F.struct(
                F.lit(draw).alias("draw"), F.max(one).alias("first"), F.max(of_home).alias("most"), F.min(of_home).alias("least")
            )
        )
    lists = rows.groupBy("key").agg(F.array(*drawn).alias("draws")).select("key", F.expr("inline(draws)"))
    both = lists.select(
        "key", "draw", "first", F.expr("if(most.drawn.home <> first.home, most, least).drawn").alias("second")
    )
    met = rows.join(both.where("first.home <> second.home"), "key").select(
        F.col("node").alias("b"), "draw", F.expr("if(home = first.home, second.a, first.a)").alias("a")
    )
    return _most_met(met, "draw").distinct()


def _most_met(met: DataFrame, *each: str) -> DataFrame:
    """For each b of the rows (a, b) the commonest a; a node has few rows, so one shuffle does."""
    return (
        met.repartition("b").groupBy("b", *each, "a").agg(F.count("*").alias("collisions"))
        .groupBy("b", *each).agg(F.max(F.struct("collisions", "a")).alias("best"))
        .select("best.a", "b")
    )


def _members(nodes: DataFrame) -> DataFrame:
    """Postings in lists of several nodes, without each node's longest: key, coordinate, node, n, score.

    The score, a sum of logarithms of list lengths, is high for the middle of a group of
    similar documents and low for one that just holds a frequent passage.
    """
    posted = nodes.select("node", "n", F.posexplode("sig").alias("coordinate", "value"))
    posted = posted.select("node", "n", "coordinate", F.xxhash64("coordinate", "value").alias("key"))
    lengths = posted.groupBy("key").agg(F.count("*").alias("length")).where("length > 1")
    own = Window.partitionBy("node")
    return (
        posted.join(lengths, "key")
        .withColumn("nth", F.row_number().over(own.orderBy(F.desc("length"), F.desc("key"))))
        .withColumn("score", F.sum(F.log2("length")).over(own))
        .where(f"nth >= {MATCHES}")
        .select("key", "coordinate", "node", "n", "score")
    )


def _apart(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Postings with their node's component (home), of the lists that hold several."""
    homed = members.join(joined, "node", "left").withColumn("home", F.coalesce("component", "node")).drop("component")
    several = homed.groupBy("key").agg(F.min("home").alias("_least"), F.max("home").alias("_most"))
    return homed.join(several.where("_least < _most").select("key"), "key")


def _leaders(members: DataFrame) -> DataFrame:
    """For each node (b) the leader (a) that it shares most lists with."""
    first = F.struct("score", (-F.col("node")).alias("least"))
    leaders = (
        members.groupBy("key")
        .agg(F.max(first).alias("leader"), F.count("*").alias("length"))
        .where("length > 1")
        .select("key", "leader")
    )
    met = members.join(leaders, "key").where("node <> -leader.least")
    most = _most_met(met.select(F.col("node").alias("b"), F.col("leader").alias("a")))
    return most.select((-F.col("a.least")).alias("a"), "b")


def _across(members: DataFrame, nodes: DataFrame, blocks: DataFrame, similarity: int) -> DataFrame:
    """Qualifying pairs of different components, as (key, a, partners) for `confirm`.

    Rows without partners name the nodes that a key needs.
    """
    posted = members.groupBy("node").agg(F.expr("bit_or(shiftleft(1L, coordinate))").alias("posted"))
    known = nodes.select("node", "sig", "bins").join(blocks, "node").join(posted, "node")
    rows = _with_commonest(members.select("key", "coordinate", "node", "n", "home"))
    parts = F.expr(f"cast(ceil(length / {CELL}) as int)")
    rows = rows.withColumn("stranger", F.expr("home <> common")).withColumn("parts", parts)
    rows = rows.withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)"))
    side = "transform(sequence(0, parts - 1), i -> struct(xxhash64(key, {}) as cell, {} as searching))"
    left, right = side.format("part, i", "true"), side.format("i, part", "false")
    sent = rows.select(
        "coordinate", "node", "n", "home", "stranger",
        F.expr(f"inline(concat(if(stranger, {left}, array()), {right}))"),
    )

    def run(batches: Batches) -> Batches:
        for cell in _runs(batches, "cell"):
            out = list(_qualified(cell, similarity))
            keys, node, partners = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(node, pa.int64()), pa.array(partners, pa.list_(pa.int64()))],
                names=["key", "a", "partners"],
            )

    dealt = sent.join(known, "node").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "key long, a long, partners array<long>")


def _with_commonest(rows: DataFrame) -> DataFrame:
    """Rows of lists with several components, with the commonest one and the list's length."""
    by_home = rows.groupBy("key", "home").agg(F.count("*").alias("size"))
    lists = (
        by_home.groupBy("key")
        .agg(F.sum("size").alias("length"), F.max(F.struct("size", "home")).alias("most"))
        .where("length > most.size")
        .select("key", "length", F.col("most.home").alias("common"))
    )
    return rows.join(lists, "key")


def _runs(batches: Batches, column: str) -> Iterator[pa.Table]:
    """Rows of sorted batches, a table for each value of ``column``."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if last > first:
                if pending and pending[-1].column(column)[-1].as_py() != values[first]:
                    yield pa.Table.from_batches(pending)
                    pending = []
                pending.append(batch.slice(first, last - first))
    if pending:
        yield pa.Table.from_batches(pending)


def _qualified(cell: pa.Table, similarity: int) -> Iterator[tuple[int, int, list[int] | None]]:
    """(key, a, partners) of a cell, and (key, node, None) for every node these need."""
    searching = cell.column("searching").to_numpy()
    if not searching.any() or searching.all():
        return
    cell = cell.combine_chunks()
    node, n, home, block, stranger, posted = (
        cell.column(c).to_numpy() for c in ("node", "n", "home", "block", "stranger", "posted")
    )
    sig = pa.concat_arrays(cell.column("sig").chunks).flatten().to_numpy().reshape(-1, COORDINATES)
    bins = pa.concat_arrays(cell.column("bins").chunks).flatten().to_numpy().view(np.uint8).reshape(-1, BINS)
    here = cell.column("coordinate")[0].as_py()
    right = np.flatnonzero(~searching)
    needed = set()
    lefts = np.flatnonzero(searching)
    for at in range(0, len(lefts), _NODES_AT_ONCE):
        left = lefts[at : at + _NODES_AT_ONCE]
        smaller, larger = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
        fits = (100 * smaller >= similarity * larger) & (home[left][:, None] != home[right])
        fits &= ~stranger[right] | (node[left][:, None] < node[right])
        if not fits.any():
            continue
        count = np.zeros(fits.shape, np.int8)
        met = posted[left][:, None] & posted[right]
        for coordinate in range(COORDINATES):
            same = sig[left, coordinate][:, None] == sig[right, coordinate]
            count += same
            if coordinate < here:  # taken from that list
                fits &= ~(same & (met >> coordinate & 1).astype(bool))
        fits &= count >= MATCHES
        i, j = np.nonzero(fits)
        for first in range(0, len(i), _PAIRS_AT_ONCE):
            some = slice(first, first + _PAIRS_AT_ONCE)
            fits[i[some], j[some]] = _alike(bins[left[i[some]]], bins[right[j[some]]], similarity)
        for row in np.flatnonzero(fits.any(axis=1)):
            i, others = left[row], right[fits[row]]
            for other in np.unique(block[others]):
                key = _pair_key(block[i], other)
                partners = node[others[block[others] == other]].tolist()
                yield key, int(node[i]), partners
                needed.update((key, b) for b in partners)
                needed.add((key, int(node[i])))
    for key, b in needed:
        yield key, b, None


def _pair_key(x: np.int64, y: np.int64) -> int:
    both = np.array(sorted((int(x), int(y))), np.int64).view(np.uint64)
    return int(text.mix(text.mix(both[:1]) + both[1:]).view(np.int64)[0])


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    similarity: int = 80,
    doc_id: str = "doc_id",
    column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the
    row's own. Null and blank texts have no shingles and no links. Rows that share an id
    are one document. Rows without an id take the component of equal texts; without one
    their component is null and they are kept. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    found = scratch.store(signatures(rows, words))
    joined = groups(rows, found, words, similarity)
    classes = (
        found.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("node"))
        .join(joined, "node", "left")
        .select("class", F.coalesce("component", "node").alias("joined"))
    )
    return (
        found.select("doc_id", "n_shingles", "class")
        .join(classes, "class", "left")
        .withColumn("component_id", F.coalesce(F.when(F.col("class").isNotNull(), F.col("joined")), F.col("doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))
    )


def keep_one(docs: DataFrame, words: int = 5, similarity: int = 80) -> DataFrame:
    """``docs`` without near-duplicates: of a component the row with the smallest id stays.

    Rows are compared by their own texts, so rows without an id, which come after all ids,
    and rows that share one are near-duplicates of others or not like all rows. Of rows that
    share id and text any one stays. Null and blank texts all stay.
    """
    key, own = scratch.unused(docs, "_key", "_own")
    found = scratch.store(near_duplicates(scratch.keyed(docs), words, similarity))
    ids = docs.select(scratch.row_key().alias("doc_id"), F.col("doc_id").cast("long").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first")
    kept = found.where("n_shingles > 0").join(ids, "doc_id").groupBy("component_id").agg(first)
    kept = kept.select(F.col("first.doc_id").alias(own))
    blank = found.where("n_shingles = 0").select(F.col("doc_id").alias(own)).distinct()
    marked = docs.withColumn(key, scratch.row_key())
    one = marked.join(kept, F.col(key) == F.col(own), "left_semi").dropDuplicates([key])
    every = marked.join(blank, F.col(key) == F.col(own), "left_semi")
    return one.unionByName(every).drop(key)
