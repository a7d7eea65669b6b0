"""Words of Arrow text columns as numpy arrays, hashed without a Python loop per word.

A word is a run of bytes other than the six ASCII blanks (``[^\\x20\\x09-\\x0D]+``);
no byte of a multi-byte character is a blank. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20  # of text handled at once; a longer text is a slice of its own
_BLOCK_BYTES = 1 << 20  # of words hashed at once
_RNG = np.random.default_rng(20250711)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, count: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < count:
        have = np.full(max(count, _BLOCK_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if count <= 4 * _BLOCK_BYTES:
            _POWERS[int(base)] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and where each row starts and the last ends."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind, wide = np.int32, column
    else:
        kind, wide = np.int64, column.cast(pa.large_binary())
    if wide.null_count:
        wide = pc.fill_null(wide, b"" if not pa.types.is_string(wide.type) else "")
    _, ends, data = wide.buffers()
    if not len(wide):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(ends, kind, len(wide) + 1, wide.offset * size).astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return everything[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts together keep to ``limit`` bytes, or alone."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        first, rows = 0, batch.num_rows
        while first < rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), rows)
            yield batch.slice(first, last - first)
            first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes as they are."""
    return _LOWER[data]


def blank(data: np.ndarray) -> np.ndarray:
    """Which bytes are blanks."""
    return _BLANK[data]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each row's first word (and the end)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    step = np.diff(inside)  # step[i]: change on entering byte i
    starts = step[:-1] == 1
    ends = step == -1
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    meets = inner[(inside[inner] == 1) & (inside[inner + 1] == 1)]  # words of two rows touch
    starts[meets] = True
    ends[meets] = True
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _BLOCK_BYTES, "right")))
        high = ends[last - 1]
        codes = _BYTE_CODE[data[low:high]] * _powers(_BASE, high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(codes, out=sums[1:])
        begin, end = starts[first:last] - low, ends[first:last] - low
        shift = _powers(_BASE_INVERSE, high - low)[begin]
        out[first:last] = (sums[end] - sums[begin]) * shift
        first = last
    return mix(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of each row's first word (and the end)."""
    starts, ends, rows = word_bounds(data, offsets)
    return hash_spans(data, starts, ends), rows


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; of all words where there are fewer."""
    if not len(words):
        return words
    if len(words) < size:
        return mix((words * _PLACE[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
    total = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        total += words[i : len(words) - size + 1 + i] * _PLACE[i]
    return mix(total)
