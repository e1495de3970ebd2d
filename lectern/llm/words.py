"""Words and word shingles of byte texts, as numpy arrays of hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
KEY_MASK = np.uint64((1 << 48) - 1)


class WordIds(dict):
    """64-bit ids of words, remembered up to a bound."""

    def __init__(self, bound: int = 200_000) -> None:
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) - (1 << 63)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words)).view(np.uint64)


def byte_texts(column: pa.Array, at_once: int = 256) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding, a few rows at a time."""
    for at in range(0, len(column), at_once):
        yield from column.slice(at, at_once).cast(pa.binary()).to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(ids: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words, of the whole text if it has fewer."""
    if not len(ids):
        return np.zeros(0, np.uint64)
    size = min(size, len(ids))
    n = len(ids) - size + 1
    out = ids[:n] + np.uint64(size)
    for i in range(1, size):
        out = out * _MULTIPLIER + ids[i:n + i]
    return np.unique(mixed(out))
