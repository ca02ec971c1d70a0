"""Words of many texts as numpy arrays, cut from the UTF-8 buffer of an Arrow column.

No Python object is made for a word. A text is handled whole, several short texts at a time, so
that intermediate arrays stay near ``CHUNK_BYTES`` (a longer text makes a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that end a word: blank, and tab to carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True

#: Bytes that are no ASCII letter or digit and not part of a longer code point.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = PUNCTUATION[128:] = False


class Words(NamedTuple):
    """Words of a run of texts. ``first[i]:first[i + 1]`` are those of the i-th text."""

    bytes: np.ndarray
    prefix: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return span_hashes(self.prefix, self.start, self.end)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE), np.full(size, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(size).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; with them, any span's hash takes one subtraction and one product."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32) if offsets else np.zeros(1, dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8), offsets


def row_runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts make up about ``limit`` bytes; every row is in exactly one run."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high


def words_of(
    data: np.ndarray, offsets: np.ndarray, low: int, high: int, separators: np.ndarray = WHITE
) -> Words:
    """Words of the texts ``low:high``, A-Z lowered."""
    base = offsets[low]
    raw = LOWER[data[base : offsets[high]]]
    edges = offsets[low : high + 1] - base
    solid = ~separators[raw]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = edges[:-1][(edges[:-1] < len(raw)) & (edges[1:] > edges[:-1])]
    begin[inner] = solid[inner]
    inner = inner[inner > 0] - 1
    last[inner] = solid[inner]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return Words(raw, prefix_hash(raw), start, end, np.searchsorted(start, edges))


def column_words(column: pa.Array, separators: np.ndarray = WHITE) -> Iterator[tuple[int, int, Words]]:
    """The words of a whole column, run by run of its rows."""
    data, offsets = texts_of(column)
    for low, high in row_runs(offsets):
        yield low, high, words_of(data, offsets, low, high, separators)
