"""Text columns as flat numpy buffers, and the words in them as 64-bit hashes.

Everything here works on one Arrow batch inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# Words of the contract's two kinds, as tables of the bytes that separate them.
SPACE_SEPARATED = np.zeros(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = True
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

# Bytes of text handled at once: bounds the memory of a task's numpy arrays.
SLICE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Seeds of the hashes: any odd numbers do, as long as all executors share them.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def bounded_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a column's bytes stay below the limit or are one row's."""
    for batch in batches:
        index = batch.schema.get_field_index(column)
        lengths = np.diff(text_buffer(batch.column(index))[1])
        start, size = 0, 0
        for row, length in enumerate(lengths.tolist()):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if batch.num_rows > start:
            yield batch.slice(start)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row starts; null is empty."""
    array = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows, and where each row starts; null is empty."""
    data, starts = text_buffer(column)
    head = (data & 0xC0) != 0x80
    counts = np.concatenate([[0], np.cumsum(head)])
    return np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32), counts[starts]


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(
    data: np.ndarray, rows: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each row (and one past the last)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~separators[data]
    opens, closes = inside.copy(), np.zeros(len(data) + 1, bool)
    opens[1:] &= ~inside[:-1]
    closes[1:] = inside[:-1] & ~inside[1:]
    cuts = rows[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] |= inside[cuts]
    closes[cuts] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(opens[:-1]), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial over the bytes, from prefix sums."""
    size = 1 << max(10, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def window_hashes(
    words: np.ndarray, rows: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every run of `width` words inside a row, with the row of each.

    A row of fewer words, but not none, is one shorter run. Returns the hashes,
    the position of each run's first word, and the first hash of each row.
    """
    total, counts = len(words), np.diff(rows)
    value = np.zeros(total, np.uint64)
    for step in range(width):
        part = words[step:] * mix(np.uint64([step + 1]))[0]
        value[: total - step] += part
    value = mix(value)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(first[-1]) + np.repeat(rows[:-1] - first[:-1], runs)
    out = value[at]
    for row in np.flatnonzero((counts > 0) & (counts < width)).tolist():
        own = words[rows[row] : rows[row + 1]]
        steps = mix(np.arange(1, len(own) + 1, dtype=np.uint64))
        short = np.uint64([(own * steps).sum() + np.uint64(len(own))])
        out[first[row]] = mix(short ^ np.uint64(0xA5A5A5A5A5A5A5A5))[0]
    return out, at, first


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary rows from flat bytes and offsets."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data.tobytes())],
    )


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Lists of numbers from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
