"""Token sequences in training order, as fixed-stride shards.

Texts are encoded, ended by an end-of-text id and cut into sequences of ``length`` ids.
Sequences are numbered by document, without gaps, and a keyed Feistel permutation of
these numbers, walked until it falls below their count, gives each its global slot. Slots
are dealt to shards by range, and a shard's file holds its records in order of slot:

    document id, number in the document, ids used (int64, int32, int32), ids (uint16 each)

A reader finds any slot by its number alone (`read`), so training reads sequentially and
resumes anywhere.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as dataset
import pyarrow.fs as pafs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch, text, tokens
from .numbering import bucket_count, running

LENGTH = 256
PER_SHARD = 8192
ROUNDS = 4
TEXT_BYTES = 8 << 20  # of text encoded at once
PARTS_PER_BAND = 64  # parts of the table whose numbers lie in one file
_HEAD = "<qii"
_HEAD_BYTES = struct.calcsize(_HEAD)
_NO_ID = -(1 << 63)

Batches = Iterator[pa.RecordBatch]


class Permutation:
    """A keyed bijection of 0 .. count - 1."""

    def __init__(self, count: int, key: int):
        self.count = count
        self.half = np.uint64(max(1, -(-max(count - 1, 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        seeds = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.keys = text.mix(seeds + np.uint64(key & 0xFFFFFFFFFFFFFFFF))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (text.mix(left ^ key) & self.mask), left
            else:
                left, right = right, left ^ (text.mix(right ^ key) & self.mask)
        return (left << self.half) | right

    def _walk(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(numbers).astype(np.uint64), back)
        outside = np.flatnonzero(x >= self.count)
        while len(outside):
            x[outside] = self._once(x[outside], back)
            outside = outside[x[outside] >= self.count]
        return x.astype(np.int64)

    def slot(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, back=False)

    def number(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, back=True)


def _record(length: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("number", "<i4"), ("used", "<i4"), ("ids", "<u2", (length,))])


def stride(length: int) -> int:
    return _HEAD_BYTES + 2 * length


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Object stores go by pyarrow's names for them; dbfs is mounted."""
    scheme, _, rest = uri.partition(":")
    if scheme == "dbfs":
        uri = "/dbfs" + rest.removeprefix("//")
    elif scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    elif scheme == "file" and not rest.startswith("//"):
        uri = "file://" + rest
    return pafs.FileSystem.from_uri(uri)


def _shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _gathered(batches: Batches) -> Batches:
    """The same rows in batches of at least `TEXT_BYTES` of text: a batch's repeated words are encoded once."""
    held, size = [], 0
    for batch in text.slices(batches):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= TEXT_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _sequences(ids: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The text each sequence comes from, its number there, and its ids; a text without ids has none."""
    sizes = np.diff(bounds)
    ended = np.insert(ids.astype("<u2"), bounds[1:][sizes > 0], tokens.END_OF_TEXT)
    sizes = sizes + (sizes > 0)
    each = -(-sizes // length)
    source = np.repeat(np.arange(len(sizes)), each)
    number = np.arange(len(source)) - (np.cumsum(each) - each)[source]
    starts = (np.cumsum(sizes) - sizes)[source] + number * length
    offsets = (2 * np.append(starts, len(ended))).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ended)]
    return source, number, pa.Array.from_buffers(pa.binary(), len(source), buffers)


_COUNTED = "doc_id long, key long, part long, row long, each long"


def _counted(rows: DataFrame, vocabulary: Broadcast, length: int) -> DataFrame:
    """Rows of texts with ids: their part of the table, their number in it, and their sequences."""

    def run(batches: Batches) -> Batches:
        encoder = tokens.ColumnEncoder(vocabulary.value)
        part, row = TaskContext.get().partitionId(), 0
        for batch in _gathered(batches):
            sizes = np.diff(encoder.column(batch.column("text"))[1])
            each = -(-(sizes + (sizes > 0)) // length)
            numbers = np.arange(row, row + len(each))
            row += len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("key"), pa.array(np.full(len(each), part)),
                    pa.array(numbers), pa.array(each, pa.int64()),
                ],
                names=["doc_id", "key", "part", "row", "each"],
            )

    return rows.mapInArrow(run, _COUNTED)


_PLACED = "slot long, shard long, doc_id long, seq_no int, ids binary"
_WRITTEN = "doc_id long, seq_no int, slot long, shard long, byte_offset long, n_tokens int, record_crc32 long"


class Changed(Exception):
    """The documents were not the same when they were read again."""


def _numbers_of(folder: str, part: int) -> pa.Table:
    """The narrow rows of one part: row, key, first."""
    files, root = _filesystem(f"{folder}/band={part // PARTS_PER_BAND}")
    if files.get_file_info(root).type == pafs.FileType.NotFound:
        return pa.table({"row": [], "key": [], "first": []}, pa.schema([(c, pa.int64()) for c in ("row", "key", "first")]))
    held = dataset.dataset(root, format="parquet", filesystem=files)
    found = held.to_table(["row", "key", "first"], filter=dataset.field("part") == part)
    return found.sort_by("row")


def _records(
    rows: DataFrame, numbers: str, vocabulary: Broadcast, count: int, length: int, key: int, per_shard: int
) -> DataFrame:
    """The sequences of all rows with their slots.

    Texts are read and encoded again where they lie, and their numbers, a few bytes a row,
    are fetched by part: no text and no id moves before it has its slot.
    """

    def run(batches: Batches) -> Batches:
        permutation, encoder, row = Permutation(count, key), tokens.ColumnEncoder(vocabulary.value), 0
        own = _numbers_of(numbers, TaskContext.get().partitionId())
        at, keys, firsts = (own.column(c).to_numpy() for c in ("row", "key", "first"))
        for batch in _gathered(batches):
            here = np.arange(row, row + batch.num_rows)
            place = np.minimum(np.searchsorted(at, here), max(len(at) - 1, 0))
            known = at[place] == here if len(at) else np.zeros(len(here), bool)
            if (keys[place[known]] != batch.column("key").to_numpy()[known]).any():
                raise Changed("documents must be the same each time they are read, as tables are")
            row += batch.num_rows
            source, number, content = _sequences(*encoder.column(batch.column("text")), length)
            if (np.isin(np.arange(len(here)), source) != known).any():
                raise Changed("documents must be the same each time they are read, as tables are")
            slots = permutation.slot(firsts[place[source]] + number)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(slots), pa.array(slots // per_shard), batch.column("doc_id").take(pa.array(source)),
                    pa.array(number, pa.int32()), content,
                ],
                names=["slot", "shard", "doc_id", "seq_no", "ids"],
            )

    return rows.mapInArrow(run, _PLACED)


def _written(records: DataFrame, folder: str, length: int, per_shard: int) -> DataFrame:
    """Writes each shard under a temporary name first; a repeated task writes the same file."""
    size = stride(length)

    def run(batches: Batches) -> Batches:
        files, root = _filesystem(folder)
        shard, name, out = None, "", None

        def close() -> None:
            if out is not None:
                out.close()
                files.move(name, f"{root}/{_shard_name(shard)}")

        for batch in batches:
            data, ends = text.flat(batch.column("ids"))
            used = np.diff(ends) // 2
            made = np.zeros(batch.num_rows, _record(length))
            made["doc"] = pc.fill_null(batch.column("doc_id"), _NO_ID).to_numpy()
            made["number"], made["used"] = batch.column("seq_no").to_numpy(), used
            made["ids"][np.arange(length) < used[:, None]] = data.view("<u2")
            made = made.view(np.uint8).reshape(-1, size)
            shards = batch.column("shard").to_numpy()
            for part in np.split(np.arange(len(shards)), np.flatnonzero(np.diff(shards)) + 1):
                if len(part) and shards[part[0]] != shard:
                    close()
                    shard = int(shards[part[0]])
                    name = f"{root}/.{_shard_name(shard)}.{uuid.uuid4().hex}"
                    out = files.open_output_stream(name)
                if len(part):
                    out.write(made[part[0] : part[-1] + 1])
            places = batch.column("slot").to_numpy() % per_shard * size
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "seq_no", "slot", "shard")),
                    pa.array(places, pa.int64()), pa.array(used, pa.int32()),
                    pa.array([zlib.crc32(record) for record in made], pa.int64()),
                ],
                names=[c.split()[0] for c in _WRITTEN.split(", ")],
            )
        close()

    return records.mapInArrow(run, _WRITTEN)


def _first_numbers(counted: DataFrame, buckets: int) -> DataFrame:
    """(part, row, key, first): the number of each row's first sequence.

    Repeated rows follow one another; they are counted by the parts of the table first, so
    no task holds more of them than a part does.
    """
    parts = counted.groupBy("doc_id", "key", "part").agg(F.max("each").alias("each"), F.count("*").alias("copies"))
    texts = parts.groupBy("doc_id", "key").agg(F.expr("max(each) * sum(copies)").alias("in_all"))
    place = F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets))
    texts = running(texts, [], place, [F.col("doc_id"), F.col("key")], F.col("in_all"), "start")
    texts = texts.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "start")
    earlier = Window.partitionBy("doc_id", "key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("copies").over(earlier), F.lit(0))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    parts = parts.withColumn("earlier", earlier).join(texts, same)
    parts = parts.select("_id", "_key", F.col("part").alias("_part"), F.expr("start + earlier * each").alias("start"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "key", "part").orderBy("row")) - 1
    return (
        counted.withColumn("nth", nth)
        .join(parts, same & (F.col("part") == F.col("_part")))
        .select("part", "row", "key", F.expr("start + nth * each").alias("first"))
    )


def materialise(
    docs: DataFrame,
    folder: str,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = 0,
    vocabulary: str = tokens.VOCABULARY,
) -> DataFrame:
    """Write all sequences of (doc_id, text) below ``folder``; a row per record comes back.

    Rows: doc_id, seq_no, slot, shard, byte_offset, n_tokens (with the end), record_crc32.
    Numbers follow a hash of id and text, so the same table gives the same slots however it
    is partitioned; repeated rows are told apart by a number only. Null and empty texts
    have no sequences. A null id is stored as the least 64-bit number. Empty tables write
    a layout and no shard. Other columns are ignored. The documents are read twice and must
    be the same both times, in the same parts, as stored tables are; else `Changed` is raised.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    shared = tokens.shared(spark, vocabulary)
    counted = scratch.store(_counted(rows, shared, length)).where("each > 0")
    total, documents = counted.agg(F.sum("each"), F.count("*")).first()
    total = total or 0
    numbers = _first_numbers(counted, bucket_count(documents))
    numbers = numbers.withColumn("band", F.expr(f"part div {PARTS_PER_BAND}"))
    held = scratch.fresh(spark)
    numbers.repartition("band").sortWithinPartitions("band", "part", "row").write.partitionBy("band").parquet(held)
    records = _records(rows, held, shared, max(total, 1), length, key, per_shard)
    in_order = records.repartition("shard").sortWithinPartitions("shard", "slot")

    files, root = _filesystem(folder)
    files.create_dir(root, recursive=True)
    layout = {"sequences": total, "length": length, "stride": stride(length), "per_shard": per_shard, "key": key}
    with files.open_output_stream(f"{root}/layout.json") as out:
        out.write(json.dumps(layout).encode())
    return scratch.store(_written(in_order, folder, length, per_shard))


def read(folder: str, slot: int, count: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document, number in it, ids) of ``count`` records from ``slot`` on, one after the other."""
    files, root = _filesystem(folder)
    with files.open_input_stream(f"{root}/layout.json") as source:
        layout = json.loads(source.read())
    size, per_shard = layout["stride"], layout["per_shard"]
    end = min(slot + count, layout["sequences"])
    while slot < end:
        shard, at = divmod(slot, per_shard)
        with files.open_input_file(f"{root}/{_shard_name(shard)}") as source:
            source.seek(at * size)
            for _ in range(min(end - slot, per_shard - at)):
                record = source.read(size)
                doc, number, used = struct.unpack_from(_HEAD, record)
                ids = np.frombuffer(record, np.uint16, used, _HEAD_BYTES)
                yield (None if doc == _NO_ID else doc), number, ids
                slot += 1
