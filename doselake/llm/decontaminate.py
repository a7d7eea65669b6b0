"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared with A-Z in lower case and each run of blanks as one space. An item of
length n may be found with up to ``floor(n * error_rate)`` edits, k. It is cut into k + 1
pieces; any occurrence with at most k edits holds one piece unchanged, shifted by at most
k. An Aho-Corasick automaton finds all exact piece hits in one pass over a text, and
Myers' bit-parallel distance verifies the stretch around each hit.

Test sets are the stated queries: they go to the tasks in blocks of `BLOCK_BYTES` of
text, and each block is searched for in all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch, text

ERROR_RATE = 0.08
BLOCK_BYTES = 4 << 20
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
_KNOWN_WINDOWS = 50_000
_UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalise(value: str | None) -> str:
    return _BLANKS.sub(" ", (value or "").translate(_UPPER_TO_LOWER)).strip(" ")


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of near equal length, with their offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def distance(item: str, window: str) -> tuple[int, int]:
    """The fewest edits between ``item`` and any part of ``window``, and where the first such ends."""
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | (1 << i)
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, now = full, 0, len(item)
    best, end = now, 0
    for at, c in enumerate(window, 1):
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            now += 1
        elif fall & top:
            now -= 1
        rise = (rise << 1) & full
        up = ((fall << 1) & full) | (full & ~(diagonal | rise))
        down = rise & diagonal
        if now < best:
            best, end = now, at
    return best, end


class Matcher:
    """All items of a block: (id, text)."""

    def __init__(self, items: list[tuple[int | None, str | None]], error_rate: float):
        self.items = []
        self.known: dict[tuple[int, str], tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        homes: dict[str, list[tuple[int, int]]] = {}
        for item_id, value in items:
            value = normalise(value)
            if not value:
                continue
            errors = int(len(value) * error_rate)
            for offset, piece in pieces(value, errors):
                homes.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, value, errors))
        for piece, places in homes.items():
            self.automaton.add_word(piece, (len(piece), places))
        if self.items:
            self.automaton.make_automaton()

    def find(self, value: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, edits, start, end) of each item's first best match, in the normalised text."""
        value = normalise(value)
        if not self.items or not value:
            return []
        windows: dict[int, list[list[int]]] = {}
        for last, (length, places) in self.automaton.iter(value):
            for item, offset in places:
                _, wanted, errors = self.items[item]
                start = last + 1 - length - offset - errors
                end = start + len(wanted) + 2 * errors
                mine = windows.setdefault(item, [])
                if mine and start <= mine[-1][1]:
                    mine[-1] = [min(mine[-1][0], start), max(mine[-1][1], end)]
                else:
                    mine.append([start, end])
        found = []
        for item, spans in sorted(windows.items()):
            item_id, wanted, errors = self.items[item]
            best = None
            for start, end in _merged(spans):
                start = max(start, 0)
                edits, at = self._distance(item, wanted, value[start:end])
                if edits <= errors and (best is None or edits < best[0]):
                    best = (edits, start + at)
            if best:
                edits, end = best
                reverse = value[max(0, end - len(wanted) - edits) : end][::-1]
                found.append((item_id, edits, end - distance(wanted[::-1], reverse)[1], end))
        return found

    def _distance(self, item: int, wanted: str, window: str) -> tuple[int, int]:
        """Shared passages bring the same windows again and again: remember some."""
        if (item, window) not in self.known:
            if len(self.known) >= _KNOWN_WINDOWS:
                self.known.clear()
            self.known[item, window] = distance(wanted, window)
        return self.known[item, window]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _blocks(benchmark: DataFrame, item_id: str, column: str) -> Iterator[list[tuple]]:
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("long"), column).orderBy(item_id, column)
    for item, value in rows.toLocalIterator():
        block.append((item, value))
        size += len(value or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    error_rate: float = ERROR_RATE,
    doc_id: str = "doc_id",
    column: str = "text",
    item_id: str = "item_id",
    item_column: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, edits, start, end): a document holds an item nearly or exactly.

    One row per row of ``docs`` and item: the leftmost match with the fewest edits, as
    offsets into the normalised text. Null and blank texts and items match nothing.
    Repeated rows give repeated results, null ids are kept. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(column).alias("text"))
    out = docs.sparkSession.createDataFrame([], _MATCHES)
    for block in _blocks(benchmark, item_id, item_column):
        out = out.union(_block_matches(rows, block, error_rate))
    return out


_MATCHES = "doc_id long, item_id long, edits int, start long, end long"


def _block_matches(rows: DataFrame, block: list[tuple], error_rate: float) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(held.value, error_rate)
        for batch in text.slices(batches):
            found: list[tuple] = []
            for doc, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.extend((doc, *match) for match in matcher.find(value))
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "item_id", "edits", "start", "end"],
            )

    return rows.mapInArrow(run, _MATCHES)


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, with or without an id."""
    return scratch.without(docs, matches(scratch.keyed(docs), benchmark, error_rate))
