"""Words and their hashes, the same on every machine and in every run."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash for each word."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that any bits of them can be compared or cut."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words, in order; fewer words make one run of all of them."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    last = len(hashes) - size + 1
    runs = np.full(last, size, np.uint64)
    for offset in range(size):
        runs = runs * _MULTIPLIER + hashes[offset : offset + last]
    return mixed(runs)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(values).view(np.int64)
