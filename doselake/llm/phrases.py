"""Phrase collocations, mined by partitioning (SON): shards first, then exact counts.

Texts are cut into pieces at punctuation and line breaks, and pieces into words; a phrase
is 2 to `LONGEST` words of a piece in a row, and everything is counted per language. The
tasks that read the table are dealt to `SHARDS` shards. A phrase with ``support``
occurrences in all has its proportional share of them in at least one shard, so

1. words are counted, which gives every shard's size and the frequent words;
2. each shard is mined completely for phrases with ``support`` times its share of the
   language's words, rounded up, whose parts may be frequent: pairs first, then longer ones;
3. the phrases of all shards are united. A shard that does not name a phrase holds fewer
   than its local support, so those whose counts and such remainders stay below
   ``support`` in sum are left out;
4. what is left is counted in all texts, by its words and not by hashes.

The number of shards is fixed, so local support and what it keeps do not fade as the input
grows; a shard is as many tasks as it takes, and its counts are merged by ranges of hashes.
What a task has counted travels as one compressed block a range: sorted 40-bit hashes, or
the phrases themselves in the last step. Frequent parts are passed to tasks as bit tables
of at most `TABLE_BITS`. Hashes that are equal by chance cost work, never a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, text

SUPPORT = 30
LONGEST = 4
NO_LANGUAGE = "und"
SHARDS = 8
WORDS_AT_ONCE = 4_000_000  # that a task counts together; a longer text is counted by itself
TABLE_BITS = 1 << 28  # 32 MB
HASH_BITS = 40
_HASH_BYTES, _COUNT_BYTES = HASH_BITS // 8, 4

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True

Batches = Iterator[pa.RecordBatch]


class Words:
    """Words of one language, and which follow the word before in the same piece."""

    def __init__(self, words: pa.Array, joined: np.ndarray):
        self.words, self.joined = words, joined

    def __len__(self) -> int:
        return len(self.joined)

    def hashes(self) -> np.ndarray:
        data, offsets = text.flat(self.words)
        return text.hash_spans(data, offsets[:-1], offsets[1:])


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, which of them follow in a piece, and each text's first word (and the end)."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _GAP[data]
    starts = gap[:-1] & ~gap[1:]
    ends = gap[1:] & ~gap[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    meets = inner[~gap[inner] & ~gap[inner + 1]]  # words of two texts touch
    starts[meets] = ends[meets] = True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    broken = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_BREAK[data], out=broken[1:])
    joined = np.zeros(len(starts), bool)
    joined[1:] = broken[starts[1:]] == broken[starts[:-1]]
    first = np.searchsorted(starts, offsets)
    joined[first[:-1][first[:-1] < len(starts)]] = False
    sizes = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=sizes[1:])
    held = data[~gap[1:-1]]
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(np.ascontiguousarray(held))]
    )
    return words, joined, first


def by_language(batches: Batches) -> Iterator[dict[str, Words]]:
    """The words of a task's texts by language, `WORDS_AT_ONCE` at a time."""
    parts: dict[str, list[Words]] = {}
    total = 0

    def whole() -> dict[str, Words]:
        return {
            lang: Words(pa.concat_arrays([s.words for s in some]), np.concatenate([s.joined for s in some]))
            for lang, some in parts.items()
        }

    for batch in text.slices(batches):
        batch = batch.take(pc.sort_indices(batch.column("lang")))
        langs = batch.column("lang").to_pylist()
        data, offsets = text.flat(batch.column("text"))
        words, joined, first = _words(text.lower(data), offsets)
        low = 0
        while low < len(langs):
            high = low
            while high < len(langs) and langs[high] == langs[low]:
                high += 1
            a, b = first[low], first[high]
            if b > a:
                parts.setdefault(langs[low], []).append(Words(words[a:b], joined[a:b]))
            low = high
        total += len(joined)
        if total >= WORDS_AT_ONCE:
            yield whole()
            parts, total = {}, 0
    if parts:
        yield whole()


def _language(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode(), np.uint8)
    return text.hash_spans(data, np.array([0]), np.array([len(data)]))[0] if len(data) else np.uint64(1)


def _runs(lang: str, hashes: np.ndarray, size: int) -> np.ndarray:
    """40-bit hashes of the ``size`` words from each word on that has as many after it."""
    if size > 1 and len(hashes) < size:
        return np.empty(0, np.uint64)
    total = np.full(len(hashes) - size + 1, _language(lang) + np.uint64(size), np.uint64)
    for i in range(size):
        total += text.mix(hashes[i : len(hashes) - size + 1 + i] + np.uint64(i))  # order matters
        total *= np.uint64(0x9E3779B97F4A7C15)
    return text.mix(total) >> np.uint64(64 - HASH_BITS)


def _in_piece(joined: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` words from each word on are of one piece."""
    ok = np.ones(max(len(joined) - size + 1, 0), bool)
    for i in range(1, size):
        ok &= joined[i : len(joined) - size + 1 + i]
    return ok


class Table:
    """A set of hashes as bits; may hold more than was put in."""

    def __init__(self, bits: int, words: np.ndarray):
        self.mask, self.words = np.uint64(bits - 1), words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _table(hashes: DataFrame) -> Broadcast:
    """Column ``hash`` as a `Table`; at most TABLE_BITS / 64 words reach the driver."""
    bits = min(TABLE_BITS, max(1 << 10, 1 << (16 * hashes.count()).bit_length()))
    place = f"hash & {bits - 1}L"
    found = hashes.groupBy(F.expr(f"shiftright({place}, 6)").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, int({place} & 63)))").alias("bits")
    ).toArrow()
    words = np.zeros(bits >> 6, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(Table(bits, words))


def _rows(columns: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and how often they are there (or the sum of their counts)."""
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    if counts is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    sums = np.diff(np.append(first, len(hashes))) if counts is None else np.add.reduceat(counts, first)
    return hashes[first], sums.astype(np.int64)


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes and their counts, byte by byte of the steps between them, compressed."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES]
    sums = np.minimum(counts, (1 << 32) - 1).astype("<u4").view(np.uint8).reshape(-1, 4)
    return pa.compress(steps.T.tobytes() + sums.T.tobytes(), "zstd", asbytes=True)


def _unpacked(block: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = pa.decompress(block, (_HASH_BYTES + _COUNT_BYTES) * size, "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(-1, size)
    steps = np.zeros((size, 8), np.uint8)
    steps[:, :_HASH_BYTES] = planes[:_HASH_BYTES].T
    sums = np.ascontiguousarray(planes[_HASH_BYTES:].T)
    return np.cumsum(steps.view("<u8").ravel()), sums.view("<u4").ravel().astype(np.int64)


def _ranges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of equal ranges of hashes starts among sorted ones, and the end."""
    edges = (np.arange(ranges + 1, dtype=np.float64) * (float(1 << HASH_BITS) / ranges)).astype(np.uint64)
    return np.searchsorted(hashes, edges)


def _range_count(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _shard() -> int:
    return TaskContext.get().partitionId() % SHARDS


#: ``n`` counts a block's entries; ``bytes`` is what a block of texts holds uncompressed.
_BLOCKS = "lang string, size int, shard int, range int, n long, bytes long, data binary"


def _blocks(lang: str, size: int, found: list[tuple]) -> pa.RecordBatch:
    """Blocks (range, n, bytes, data) of one language and size, as rows."""
    part, n, sizes, data = zip(*found, strict=True) if found else ((), (), (), ())
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = [[lang] * len(n), [size] * len(n), [_shard()] * len(n), part, n, sizes, data]
    return _rows(columns, kinds, [c.split()[0] for c in _BLOCKS.split(", ")])


def _text_blocks(
    lang: str, size: int, ranges: int, phrases: pa.Array, hashes: np.ndarray, counts: np.ndarray
) -> pa.RecordBatch:
    """Phrases and their counts as one compressed block a range of their hashes."""
    order = np.argsort(hashes)
    phrases, counts = phrases.take(pa.array(order)).cast(pa.binary()), counts[order].astype("<i8")
    bounds = _ranges(hashes[order], ranges)
    found = []
    for k in np.flatnonzero(np.diff(bounds)):
        a, b = int(bounds[k]), int(bounds[k + 1])
        spelt = pc.binary_join(pa.ListArray.from_arrays([0, b - a], phrases[a:b]), b"\n")[0].as_py()
        raw = counts[a:b].tobytes() + spelt
        found.append((int(k), b - a, len(raw), pa.compress(raw, "zstd", asbytes=True)))
    return _blocks(lang, size, found)


_COUNTS = "lang string, phrase string, words int, hash long, f long"


def _merged(blocks: DataFrame, support: int) -> DataFrame:
    """The phrases of text blocks that have the support, with their exact counts."""

    def run(batches: Batches) -> Batches:
        held: list[tuple[pa.Array, np.ndarray]] = []
        key = None

        def done() -> Batches:
            if not held:
                return
            table = pa.table({"phrase": pa.concat_arrays([p for p, _ in held]), "f": np.concatenate([c for _, c in held])})
            sums = table.group_by("phrase").aggregate([("f", "sum")])
            sums = sums.filter(pc.greater_equal(sums["f_sum"], support)).combine_chunks()
            count, (_, lang, size) = sums.num_rows, key
            if not count:
                return
            phrases = sums["phrase"].combine_chunks()
            data, offsets = text.flat(phrases)
            hashes = _runs(lang, text.hash_spans(data, offsets[:-1], offsets[1:]), 1) if size == 1 else np.zeros(count, np.uint64)
            yield _rows(
                [
                    pa.array([lang] * count, pa.string()), phrases.cast(pa.string()), pa.array([size] * count, pa.int32()),
                    hashes.view(np.int64), sums["f_sum"].combine_chunks(),
                ],
                [None, None, None, pa.int64(), None], [c.split()[0] for c in _COUNTS.split(", ")],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "lang", "size", "bytes", "n", "data"))
            for part, lang, size, length, n, block in zip(*columns, strict=True):
                if (part, lang, size) != key:
                    yield from done()
                    held, key = [], (part, lang, size)
                raw = pa.decompress(block, length, "zstd", asbytes=True)
                spelt = pa.array(raw[8 * n :].split(b"\n"), pa.binary())
                held.append((spelt, np.frombuffer(raw, "<i8", n)))
        yield from done()

    dealt = blocks.repartition("range", "lang", "size").sortWithinPartitions("range", "lang", "size")
    return dealt.mapInArrow(run, _COUNTS)


def word_counts(docs: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, hash, f) of the single words with the support, and (lang, shard, n): all words."""
    ranges = _range_count(docs)

    def run(batches: Batches) -> Batches:
        for found in by_language(batches):
            for lang, words in found.items():
                counts = pc.value_counts(words.words)
                data, offsets = text.flat(counts.field("values"))
                hashes = _runs(lang, text.hash_spans(data, offsets[:-1], offsets[1:]), 1)
                yield _blocks(lang, 0, [(-1, len(words), None, None)])
                yield _text_blocks(lang, 1, ranges, counts.field("values"), hashes, counts.field("counts").to_numpy())

    blocks = scratch.store(docs.mapInArrow(run, _BLOCKS))
    totals = blocks.where("range < 0").groupBy("lang", "shard").agg(F.sum("n").alias("n"))
    return scratch.store(_merged(blocks.where("range >= 0"), support)), scratch.store(totals)


def mine(
    docs: DataFrame, totals: DataFrame, sizes: list[int], parts: Broadcast, below: int, support: int
) -> DataFrame:
    """(lang, hash) of all phrases of ``sizes`` words that may have ``support`` occurrences.

    ``totals`` has the words of each language in each shard; ``parts`` holds what the phrases
    of ``below`` words are that may.
    """
    ranges = _range_count(docs)

    def count(batches: Batches) -> Batches:
        for found in by_language(batches):
            for lang, words in found.items():
                hashes = words.hashes()
                allowed = _in_piece(words.joined, below) & parts.value.has(_runs(lang, hashes, below))
                for size in sizes:
                    if len(words) < size:
                        continue
                    ok = _in_piece(words.joined, size)
                    for i in range(size - below + 1):
                        ok &= allowed[i : len(ok) + i]
                    named, counts = _counted(_runs(lang, hashes, size)[ok])
                    bounds = _ranges(named, ranges)
                    some = [(int(k), slice(bounds[k], bounds[k + 1])) for k in np.flatnonzero(np.diff(bounds))]
                    packed = [(k, len(named[at]), None, _packed(named[at], counts[at])) for k, at in some]
                    yield _blocks(lang, size, packed)

    def merge(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        key = None

        def done() -> Batches:
            if not held:
                return
            lang, size, _, _, least = key
            named, counts = _counted(*(np.concatenate(c) for c in zip(*held, strict=True)))
            named, counts = named[counts >= least], counts[counts >= least]
            yield _rows(
                [
                    pa.array([lang] * len(named), pa.string()), pa.array(np.full(len(named), size, np.int32)),
                    named.view(np.int64), counts - (least - 1),
                ],
                [None, None, pa.int64(), pa.int64()], ["lang", "size", "hash", "over"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "size", "shard", "range", "least", "n", "data"))
            for *own, n, block in zip(*columns, strict=True):
                if tuple(own) != key:
                    yield from done()
                    held, key = [], tuple(own)
                held.append(_unpacked(block, n))
        yield from done()

    in_all = totals.groupBy("lang").agg(F.sum("n").alias("all"))
    # A shard's share of the support, rounded up.
    least = F.expr(f"greatest(1, cast(({support} * cast(n as decimal(20)) + all - 1) div all as long))")
    supports = scratch.store(totals.join(in_all, "lang").select("lang", "shard", least.alias("least")))
    group = ["lang", "size", "shard", "range", "least"]
    blocks = docs.mapInArrow(count, _BLOCKS).join(supports, ["lang", "shard"])
    dealt = blocks.repartition(*group).sortWithinPartitions(*group)
    found = dealt.select(*group, "n", "data").mapInArrow(merge, "lang string, size int, hash long, over long")
    united = found.groupBy("lang", "size", "hash").agg(F.sum("over").alias("over"))
    rest = supports.groupBy("lang").agg(F.sum(F.col("least") - 1).alias("rest"))
    return united.join(rest, "lang").where(f"over + rest >= {support}").select("lang", "hash")


def phrase_counts(docs: DataFrame, wanted: Broadcast, longest: int, support: int) -> DataFrame:
    """(lang, phrase, words, hash, f): exact counts, of phrases whose hash is wanted and that have the support."""
    ranges = _range_count(docs)

    def run(batches: Batches) -> Batches:
        for found in by_language(batches):
            for lang, words in found.items():
                coded = words.words.dictionary_encode()
                spelt, codes = coded.dictionary, coded.indices.to_numpy().astype(np.uint64)
                hashes = words.hashes()
                for size in range(2, min(longest, len(words)) + 1):
                    runs = _runs(lang, hashes, size)
                    at = np.flatnonzero(_in_piece(words.joined, size) & wanted.value.has(runs))
                    if not len(at):
                        continue
                    # By hash first, then by the words themselves.
                    keys = [*(codes[at + i] for i in range(size)), runs[at]]
                    order = np.lexsort(keys)
                    fresh = np.zeros(len(at), bool)
                    fresh[0] = True
                    for key in keys:
                        fresh[1:] |= key[order[1:]] != key[order[:-1]]
                    first = np.flatnonzero(fresh)
                    some = [spelt.take(pa.array(key[order[first]])) for key in keys[:-1]]
                    phrases = pc.binary_join_element_wise(*some, pa.scalar(b" ", pa.large_binary()))
                    counts = np.diff(np.append(first, len(at)))
                    yield _text_blocks(lang, size, ranges, phrases, runs[at][order[first]], counts)

    return _merged(docs.mapInArrow(run, _BLOCKS), support)


def candidates(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all words and phrases with the support; (lang, n) of all languages."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    rows = docs.select(lang, F.coalesce("text", F.lit("")).alias("text"))
    words, totals = word_counts(rows, support)
    wanted = scratch.store(mine(rows, totals, [2], _table(words), 1, support)).select("hash")
    if longest > 2:
        longer = mine(rows, totals, list(range(3, longest + 1)), _table(wanted), 2, support)
        wanted = wanted.union(scratch.store(longer).select("hash"))
    found = phrase_counts(rows, _table(wanted), longest, support)
    in_all = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    return scratch.store(words.union(found).drop("hash")), scratch.store(in_all)


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of phrases of several words, at their weakest cut."""
    parts = found.select("lang", F.col("phrase").alias("part"), "f")
    whole = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cut = whole.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "*",
        F.expr("substring_index(phrase, ' ', k)").alias("left"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("right"),
    )
    for side, value in (("left", "l"), ("right", "r")):
        own = parts.select("lang", F.col("part").alias(side), F.col("f").alias(value))
        cut = cut.join(own, ["lang", side])
    score = F.expr("2000000 * cast(a as decimal(19)) div (cast(l as decimal(19)) + r)")
    weakest = cut.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least")
    )
    return weakest.join(totals, "lang").select("lang", "phrase", "words", "a", "least.l", "least.r", "n", "least.score")


def _covered(found: DataFrame, share: int) -> DataFrame:
    """(lang, phrase) of phrases that mostly occur inside a longer one."""
    spelt = found.where("words > 2").select("f", "lang", "words", F.split("phrase", " ").alias("w"))
    places = (
        "flatten(transform(sequence(2, words - 1), m -> "
        "transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    inside = spelt.select("lang", F.explode(F.expr(places)).alias("phrase"), "f")
    longest = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    enough = F.expr(f"100 * cast(longer as decimal(19)) >= {share} * cast(f as decimal(19))")
    return found.join(longest, ["lang", "phrase"]).where(enough).select("lang", "phrase")


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, best: int = 2000, covered: int = 80
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` the
    language's words. Phrases that occur in ``covered`` percent of the cases inside a longer
    one with the support are left out. A null text has no words, a null language is
    `NO_LANGUAGE`; repeated rows count as often as they are there. Texts are read whole.
    Other columns are ignored; an empty table, or one of blanks, has no rows.
    """
    found, totals = candidates(docs, support, longest)
    rows = scored(found, totals).join(_covered(found, covered), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
