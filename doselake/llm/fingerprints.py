"""Document fingerprints: improbable byte windows in chained Bloom filters.

Every window of `WINDOW` bytes has an entropy level. How rare a level is comes from all
windows of all documents. Over each run of `WINDOW` neighbouring windows the rarest (the
leftmost of equals) gets a vote, and windows with `POPULAR` votes are the features of a
text. Features fill Bloom filters of `FILTER_BITS` bits, `FEATURES_PER_FILTER` each, one
after the other. The likeness of two fingerprints is the mean, over the filters of the one
with fewer, of the best bit overlap with a filter of the other, less what chance explains.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text

WINDOW = 64
POPULAR = 16
LEVELS = 1001
LEAST_LEVEL = 150  # windows of few different bytes say nothing
FILTER_BITS = 2048
FEATURES_PER_FILTER = 160
HASHES = 5
CHANCE = 0.3  # of the way from chance to full overlap that still counts as none
SLICE_BYTES = 1 << 19
ROWS_PER_PART = 1024
BINS = 1 << 16

Batches = Iterator[pa.RecordBatch]

_SCALE = 1 << 20
_N_LOG_N = np.round(
    [n * np.log2(n) * _SCALE if n else 0 for n in range(WINDOW + 1)]
).astype(np.int64)
_GAIN = np.diff(_N_LOG_N)  # by how many of the same byte are there already
_FULL = int(_N_LOG_N[WINDOW])
_NEVER = np.int64(1) << np.int64(62)
_FILTER_BYTES = FILTER_BITS // 8
_HALO = 3 * WINDOW


def _levels(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The entropy level of the window that starts at each byte; -1 where none fits in its row.

    With n occurrences of a byte adding n log n, a window's sum changes only by the byte that
    enters and the one that leaves, so all sums are one running sum.
    """
    size = len(data)
    if size < WINDOW:
        return np.full(size, -1, np.int64)
    lengths = np.diff(offsets)
    start = np.repeat(offsets[:-1], lengths)
    place = np.arange(size) - start
    behind = np.minimum(place, 255).astype(np.uint8)
    same_before = np.zeros(size, np.uint8)
    same_after = np.zeros(size, np.uint8)
    for shift in range(1, WINDOW):
        same = (data[shift:] == data[:-shift]) & (behind[shift:] >= shift)
        same_before[shift:] += same
        same_after[:-shift] += same
    gained = np.zeros(size + 1, np.int64)
    np.cumsum(_GAIN[same_before], out=gained[1:])
    lost = np.zeros(size + 1, np.int64)
    np.cumsum(_GAIN[same_after], out=lost[1:])
    fits = place + WINDOW <= np.repeat(lengths, lengths)
    at = np.flatnonzero(fits)
    begin = start[at]
    sums = (gained[at + WINDOW] - gained[begin]) - (lost[at] - lost[begin])
    out = np.full(size, -1, np.int64)
    out[at] = ((_FULL - sums) * (LEVELS - 1)) // _FULL
    return out


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
    """Parts of bounded size: bytes, row offsets, first row, shift, and the core's range.

    Rows come together where they fit; a longer one is cut into overlapping parts.
    """
    if len(data) <= 2 * SLICE_BYTES or len(offsets) > 2:
        yield data, offsets, 0, 0, 0, len(data)
        return
    for low in range(0, len(data), SLICE_BYTES):
        high = min(low + SLICE_BYTES, len(data))
        a, b = max(0, low - _HALO), min(len(data), high + _HALO)
        yield data[a:b], np.array([0, b - a]), 0, a, low - a, high - a


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each entropy level; a task sends `LEVELS` sums."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(LEVELS, np.int64)
        for batch in text.slices(batches, limit=SLICE_BYTES):
            for data, offsets, _, _, low, high in _pieces(*text.flat(batch.column("text"))):
                levels = _levels(data, offsets)[low:high]
                total += np.bincount(levels[levels >= 0], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(LEVELS), pa.int32()), pa.array(total, pa.int64())], names=["level", "count"]
        )

    sums = docs.select("text").mapInArrow(run, "level int, count long")
    total = np.zeros(LEVELS, np.int64)
    for level, count in sums.groupBy("level").agg(F.sum("count")).collect():
        total[level] = count
    return total


def rarity(counts: np.ndarray) -> np.ndarray:
    """The rank of each level, rarest first; equally rare levels by height."""
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    ranks[:LEAST_LEVEL] = -1
    return ranks


def _features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every feature, in order."""
    rows, hashes = [], []
    for part, bounds, first, _, low, high in _pieces(data, offsets):
        levels = _levels(part, bounds)
        rank = np.where(levels >= 0, ranks[levels], -1)
        key = np.full(len(part) + WINDOW - 1, _NEVER)
        known = np.flatnonzero(rank >= 0)
        key[known + WINDOW - 1] = (rank[known] << 32) | known
        # Rows end with WINDOW - 1 bytes at which no window starts, so no run reaches from
        # one row's windows to the next one's.
        least = key
        for shift in (1, 2, 4, 8, 16, 32):
            least = np.minimum(least[:-shift], least[shift:]) if len(least) > shift else least[:0]
        least = np.concatenate([least, _tails(key)])
        votes = np.bincount(least[least < _NEVER] & 0xFFFFFFFF, minlength=len(part))
        chosen = np.flatnonzero(votes >= POPULAR)
        chosen = chosen[(chosen >= low) & (chosen < high)]
        rows.append(np.searchsorted(bounds, chosen, "right") - 1 + first)
        hashes.append(text.hash_spans(part, chosen, chosen + WINDOW))
    return np.concatenate(rows), np.concatenate(hashes)


def _tails(key: np.ndarray) -> np.ndarray:
    """Minima of the runs that reach beyond the end; windows there are all of the last row."""
    tail = key[max(0, len(key) - WINDOW + 1) :]
    return np.minimum.accumulate(tail[::-1])


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Filters (n, bytes) of each text; an empty text has none."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    data = np.frombuffer(b"".join(texts), np.uint8)
    rows, hashes = _features(data, offsets, ranks) if len(data) else (np.empty(0, np.int64), np.empty(0, np.uint64))
    counts = np.bincount(rows, minlength=len(texts))
    # A text without features is its own.
    plain = [i for i, t in enumerate(texts) if t and not counts[i]]
    if plain:
        own = [int.from_bytes(hashlib.blake2b(texts[i], digest_size=8).digest(), "little") for i in plain]
        rows = np.concatenate([rows, plain])
        hashes = np.concatenate([hashes, np.array(own, np.uint64)])
        order = np.argsort(rows, kind="stable")
        rows, hashes = rows[order].astype(np.int64), hashes[order]
        counts = np.bincount(rows, minlength=len(texts))
    filters = -(-counts // FEATURES_PER_FILTER)
    first = np.concatenate([[0], np.cumsum(filters)])
    nth = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
    home = first[rows] + nth // FEATURES_PER_FILTER
    bits = np.zeros(first[-1] * FILTER_BITS, bool)
    for i in range(HASHES):
        place = (hashes >> np.uint64(11 * i)) & np.uint64(FILTER_BITS - 1)
        bits[home * FILTER_BITS + place.astype(np.int64)] = True
    packed = np.packbits(bits).reshape(-1, _FILTER_BYTES)
    return [packed[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def encode(filters: np.ndarray) -> str:
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), np.uint8).reshape(-1, _FILTER_BYTES)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 (no more alike than chance) to 1; of two empty fingerprints 1, of one 0."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    if len(one) > len(other):
        one, other = other, one
    ones = np.bitwise_count(one).sum(axis=1).astype(np.float64)
    others = np.bitwise_count(other).sum(axis=1).astype(np.float64)
    best = np.zeros(len(one))
    for i, bits in enumerate(one):
        both = np.bitwise_count(bits & other).sum(axis=1)
        chance = ones[i] * others / FILTER_BITS
        most = np.minimum(ones[i], others)
        floor = chance + CHANCE * (most - chance)
        best[i] = np.clip((both - floor) / np.maximum(most - floor, 1e-9), 0, 1).max()
    return float((best * ones).sum() / ones.sum())


def _in_parts(rows: DataFrame) -> DataFrame:
    """Rows by ``part``, runs of ascending ids, each ended by the row after it.

    Ids are counted in `BINS` equal bins, at most so many rows to collect, and bins are
    joined to parts of near equal numbers of rows.
    """
    spark = rows.sparkSession
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (low or 0), (high or 0)
    width = -(-(high - low + 1) // BINS)
    bin_of = F.coalesce(F.expr(f"int((doc_id - {low}L) div {width}L)"), F.lit(-1))
    bins = rows.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"))
    bins = sorted(tuple(r) for r in bins.collect())
    parts, firsts, filled = [], [], ROWS_PER_PART
    for at, count, first in bins:
        if filled >= ROWS_PER_PART:
            firsts.append((len(firsts) - 1, first))
            filled = 0
        parts.append((at, len(firsts) - 1))
        filled += count
    # The first row follows the last one.
    firsts = [(part if part >= 0 else len(firsts) - 1, first) for part, first in firsts]
    parts = F.broadcast(spark.createDataFrame(parts, "_bin int, part int"))
    firsts = F.broadcast(spark.createDataFrame(firsts, "part int, _first long"))
    own = rows.withColumn("_bin", bin_of).join(parts, "_bin").select("part", F.lit(0).alias("after"), "doc_id", "text")
    after = rows.join(firsts, F.col("doc_id").eqNullSafe(F.col("_first"))).select("part", F.lit(1), "doc_id", "text")
    return own.union(after).repartition("part").sortWithinPartitions("part", "after", "doc_id", "text")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    In the edited text the last quarter of the code points (rounded down) is replaced by
    the first as many of the next document in order of id, or all it has; the first
    follows the last. Rows of equal ids follow each other by text, null ids come first.
    A null text is empty. One document alone follows itself. Other columns are ignored.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text")
    )
    ranks = docs.sparkSession.sparkContext.broadcast(rarity(level_counts(rows)))

    def run(batches: Batches) -> Batches:
        waiting: list[tuple] = []  # the row whose next is not known yet: part, id, text, filters
        for batch in text.slices(batches, limit=SLICE_BYTES):
            columns = [batch.column(c).to_pylist() for c in ("part", "after", "doc_id", "text")]
            filters = digests([t.encode() for t in columns[3]], ranks.value)
            done = []
            for part, after, key, value, own in zip(*columns, filters, strict=True):
                if waiting and waiting[0][0] == part:
                    done.append((waiting.pop(), value, own))
                if not after:
                    waiting = [(part, key, value, own)]
            yield _finished(done, ranks.value)

    return _in_parts(rows).mapInArrow(run, _RESULT)


def _finished(done: list[tuple], ranks: np.ndarray) -> pa.RecordBatch:
    edited = [edit(value, following).encode() for (_, _, value, _), following, _ in done]
    changed = digests(edited, ranks)
    out = [
        (
            key, len(value), hashlib.sha256(new).hexdigest(), encode(own), encode(other),
            likeness(own, other), likeness(own, following),
        )
        for ((_, key, value, own), _, following), new, other in zip(done, edited, changed, strict=True)
    ]
    names = [c.split()[0] for c in _RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def edit(value: str, following: str) -> str:
    cut = len(value) // 4
    return value[: len(value) - cut] + following[:cut]
