"""Byte-level text helpers for Arrow batches: words, their hashes, chunks of documents.

Everything here works on the UTF-8 bytes of a batch at once. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

SPACE = b" \t\n\r\x0b\x0c"

# Bytes of pieces: all but white space.
PIECE = np.ones(256, dtype=bool)
PIECE[list(SPACE)] = False

# A-Z to a-z; all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words: digits, letters, and all of the bytes of characters beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True

_BASE = 0x9E3779B97F4A7C55  # bases are odd, so that they have inverses modulo 2**64
_powers: dict[int, np.ndarray] = {}
_SEGMENT = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, _SEGMENT + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base][:n]


def inverse_powers(n: int, base: int = _BASE) -> np.ndarray:
    return powers(pow(base, -1, 1 << 64), n)


def prefix_hashes(data: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Polynomial hashes of all prefixes of ``data``, the empty one first."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hashes of data[start:end], whatever their place."""
    return (prefix[ends] - prefix[starts]) * inverse_powers(len(prefix), base)[starts]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string()) if not pa.types.is_binary(column.type) else column
        column = column.cast(pa.large_binary())
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    return np.frombuffer(buffer if buffer is not None else b"", np.uint8), offsets


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    data, offsets = text_bytes(column)
    raw = data.tobytes() if len(data) else b""
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def spans(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``limit`` bytes in all, or one longer row."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def words(data: np.ndarray, rows: np.ndarray, table: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``table`` bytes; ``rows`` are the offsets of texts
    in ``data``, and no run goes over one."""
    inside = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[rows] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; computed in pieces, so that tables of powers stay small."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + _SEGMENT, side="right")), i + 1)
        prefix = prefix_hashes(data[base : ends[j - 1]])
        out[i:j] = range_hashes(prefix, starts[i:j] - base, ends[i:j] - base)
        i = j
    return mix(out)


def chunk_number(sequence: int) -> int:
    """A number for the ``sequence``-th chunk of this task, the same when it runs again."""
    task = TaskContext.get()
    return ((task.partitionId() if task else 0) << 32) | sequence


def pieces(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of consecutive slices of ``values`` with these lengths."""
    raw, ends = values.tobytes(), np.cumsum(counts) * values.itemsize
    starts = ends - counts * values.itemsize
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
