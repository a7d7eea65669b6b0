"""Edit-aware token counts: a segment tree of pre-token runs per document.

A text's leaves are runs of pre-tokens of about `LEAF` characters; a leaf ends where a
space stands between two other characters, so its tokens do not depend on its neighbours.
Each tree node holds the characters and tokens below it. An edit finds the leaves it
touches by walking down the character sums, takes in a neighbour where it has spoilt the
boundary between them, encodes that region anew and updates the sums above it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text, tokens

LEAF = 256
_CUT = re.compile(r"(?<=\S)\x20(?=\S)")

Batches = Iterator[pa.RecordBatch]


def leaves(value: str, size: int = LEAF) -> list[str]:
    """Consecutive parts of at least ``size`` characters, but for the last."""
    out, at = [], 0
    while len(value) - at > size:
        cut = _CUT.search(value, at + size)
        if cut is None:
            break
        out.append(value[at : cut.start()])
        at = cut.start()
    out.append(value[at:])
    return out


class Tree:
    """Sums over leaves: node i has the children 2i and 2i + 1, leaves are the last level."""

    def __init__(self, parts: list[tuple[int, int]]):
        self.width = 1 << max(0, len(parts) - 1).bit_length()
        self.leaves = len(parts)
        self.sums = [(0, 0)] * self.width + parts + [(0, 0)] * (self.width - len(parts))
        for i in range(self.width - 1, 0, -1):
            self._add(i)

    def _add(self, i: int) -> None:
        left, right = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = (left[0] + right[0], left[1] + right[1])

    def total(self) -> tuple[int, int]:
        return self.sums[1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (or the last), and where it starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if place >= start + self.sums[i][0] and self.sums[i + 1][0]:
                start += self.sums[i][0]
                i += 1
        return i - self.width, start

    def part(self, leaf: int) -> tuple[int, int]:
        return self.sums[self.width + leaf]

    def replace(self, first: int, last: int, parts: list[tuple[int, int]]) -> None:
        """Put ``parts`` in place of leaves ``first`` to ``last``, and update the sums above."""
        if len(parts) > last - first + 1:
            kept = self.sums[self.width : self.width + self.leaves]
            self.__init__(kept[:first] + parts + kept[last + 1 :])
            return
        parts = parts + [(0, 0)] * (last - first + 1 - len(parts))
        low, high = self.width + first, self.width + last
        self.sums[low : high + 1] = parts
        while low > 1:
            low, high = low // 2, high // 2
            for i in range(low, high + 1):
                self._add(i)


class Counted:
    """A text and its tree; edits change both."""

    def __init__(self, value: str, parts: list[tuple[int, int]]):
        self.text, self.tree = value, Tree(parts)
        self.encoded = 0  # characters encoded anew

    def edit(self, start: int, length: int, insert: str, encoder: tokens.Encoder) -> None:
        """Replace ``length`` characters from ``start``, both cut to the text."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(length, 0), len(self.text))
        first, low = self.tree.find(start)
        last, at = self.tree.find(max(end - 1, start))
        high = at + self.tree.part(last)[0]
        self.text = self.text[:start] + insert + self.text[end:]
        grown = len(insert) - (end - start)
        high += grown
        while low > 0 and not self._cut(low):
            first -= 1
            low -= self.tree.part(first)[0]
        while high < len(self.text) and not self._cut(high):
            last += 1
            high += self.tree.part(last)[0]
        region = leaves(self.text[low:high])
        self.encoded += high - low
        self.tree.replace(first, last, [(len(p), encoder.count(p)) for p in region])

    def _cut(self, place: int) -> bool:
        return _CUT.match(self.text, place) is not None


def trees(docs: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(doc_id, text, chars, tokens): the leaves of every text. Null texts are empty."""
    shared = tokens.shared(docs.sparkSession, vocabulary)

    def run(batches: Batches) -> Batches:
        encoder = tokens.Encoder(shared.value)
        for batch in text.slices(batches):
            values = batch.column("text").to_pylist()
            cut = [leaves(v) for v in values]
            chars = [[len(p) for p in parts] for parts in cut]
            counts = [[encoder.count(p) for p in parts] for parts in cut]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text"),
                    pa.array(chars, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())),
                ],
                names=["doc_id", "text", "chars", "tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, chars array<int>, tokens array<int>")


_RESULT = "doc_id long, n_edits long, tokens_before long, tokens_after long, chars_after long, chars_encoded long"


def recount(kept: DataFrame, edits: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Token counts of every document of `trees` before and after its edits.

    ``edits`` is (doc_id, seq, start, length, insert); a document's edits are made in order
    of ``seq`` (then start, length, insert), each on what the ones before have left; one that
    is there twice is made once. Places count code points and are cut to the text; nulls are
    0 or empty. Edits of unknown or null ids do nothing. Rows that share an id are edited
    alike: a task holds the edits of one id and one text at a time, and of equal texts only
    the first is edited.
    """
    none = F.lit(None).cast("array<int>")
    documents = kept.select(
        "doc_id", F.lit(1).alias("step"), F.lit(None).cast("long").alias("seq"), F.lit(0).alias("start"),
        F.lit(0).alias("length"), "text", "chars", "tokens",
    )
    changes = edits.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.lit(0), F.col("seq").cast("long"),
        F.coalesce(F.col("start"), F.lit(0)).cast("int"), F.coalesce(F.col("length"), F.lit(0)).cast("int"),
        F.coalesce(F.col("insert"), F.lit("")), none, none,
    )
    shared = tokens.shared(kept.sparkSession, vocabulary)

    def run(batches: Batches) -> Batches:
        encoder = tokens.Encoder(shared.value)
        key: object = run
        made: list[tuple] = []
        last, result = None, ()
        for batch in text.slices(batches):
            out: list[tuple] = []
            columns = (c.to_pylist() for c in batch.columns)
            for doc, step, seq, start, length, value, chars, counts in zip(*columns, strict=True):
                if doc != key:
                    key, made, last = doc, [], None
                if step == 0:
                    if not made or made[-1] != (seq, start, length, value):
                        made.append((seq, start, length, value))
                    continue
                if value != last:
                    counted = Counted(value, list(zip(chars, counts, strict=True)))
                    before = counted.tree.total()[1]
                    for _, at, size, insert in made:
                        counted.edit(at, size, insert, encoder)
                    last = value
                    result = (len(made), before, counted.tree.total()[1], len(counted.text), counted.encoded)
                out.append((doc, *result))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in _RESULT.split(", ")]
            )

    rows = changes.toDF(*documents.columns).union(documents)
    # Rows without an id have no edits and need not meet.
    alone = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))
    rows = rows.withColumn("_alone", alone).repartition("doc_id", "_alone").drop("_alone")
    sent = rows.sortWithinPartitions("doc_id", "step", "seq", "start", "length", "text")
    return sent.mapInArrow(run, _RESULT)
