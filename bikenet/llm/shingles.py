"""Sets of hashed word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

from bikenet.llm.text_arrays import Words, column_words, mix

WIDTH = 5

_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def text_shingles(words: Words, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    With fewer words than ``width`` the whole sequence is the one shingle; without words, none.
    """
    own = words.hashes()
    n = len(own) - width + 1
    if n > 0:
        total = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            total += own[k : k + n] * _PLACE[k]
        total = mix(total)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= width:
            found = np.sort(total[low : high - width + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif high > low:
            short = (own[low:high] * _PLACE[: high - low]).sum(dtype=np.uint64)
            yield mix(np.array([short ^ np.uint64(high - low)], dtype=np.uint64))
        else:
            yield own[:0]


def column_shingles(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    for _, _, words in column_words(column):
        yield from text_shingles(words, width)


def set_digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a sorted set."""
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def long_lists(parts: list[np.ndarray]) -> pa.ListArray:
    """64-bit arrays as a column of array<bigint>."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
