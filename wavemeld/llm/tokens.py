"""Words and shingles of whole batches of texts, as numpy arrays of hashes.

Texts are taken from Arrow as bytes.  A-Z are lower-cased and nothing else
changes; words are runs of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return.  Batches are worked on in chunks of a few
million bytes, so the memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
SHINGLE_WORDS = 5

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20_240_501))
#: A random number for each byte value; white space counts nothing.
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RANDOM.integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """1, B, B², ... modulo 2^64: n of them at least."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers), 4096), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits will do as a hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a chunk of texts; text i has words first[i] to first[i + 1]."""

    rows: range
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        at = int(self.starts[0])
        size = int(self.ends[-1]) - at
        gaps = np.diff(np.append(self.starts, self.ends[-1]))
        place = np.arange(size, dtype=np.int32) - np.repeat((self.starts - at).astype(np.int32), gaps)
        value = _VALUE[self.data[at:at + size]]
        value *= powers(int(gaps.max()))[place]
        return mix(np.add.reduceat(value, self.starts - at) + (self.ends - self.starts).astype(np.uint64))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls have no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(rows, offsets from 0, bytes) of a string column, a few million bytes or one text at a time."""
    at, data = _column(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        j = min(j, n)
        yield range(i, j), at[i:j + 1] - at[i], data[at[i]:at[j]]
        i = j


def words(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column, chunk by chunk."""
    for rows, at, raw in chunks(column, most):
        data = _FOLD[raw]
        inside = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(_SPACE[data], out=inside[1:-1])
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        # A text's first byte begins a word and its last byte ends one, whatever its neighbours are.
        filled = np.flatnonzero(np.diff(at) > 0)
        heads, tails = at[filled], at[filled + 1] - 1
        begins[heads] = inside[heads + 1]
        ends[tails] = inside[tails + 1]
        starts = np.flatnonzero(begins)
        yield Words(rows, data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at))


def shingles(word_hashes: np.ndarray, first: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k adjacent words, one for each word that has k - 1 after it; the rest of the array is not used.

    Returns (hashes, counts): text i has ``counts[i]`` shingles, from word ``first[i]`` on.
    """
    n = len(word_hashes)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, n)):
        total[:n - i] += word_hashes[i:] * _PLACE[i]
    return mix(total), np.maximum(np.diff(first) - (k - 1), 0)


def short_hash(word_hashes: np.ndarray) -> np.uint64:
    """One hash for a sequence of fewer words than a shingle has."""
    n = len(word_hashes)
    total = (word_hashes * _PLACE[:n]).sum(dtype=np.uint64) + np.uint64(n)
    return mix(np.array([total], dtype=np.uint64))[0]


def shingle_sets(column: pa.Array, k: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes); a text with fewer words has its whole sequence as one."""
    for chunk in words(column):
        hashes = chunk.hashes()
        grams, counts = shingles(hashes, chunk.first, k)
        for row, begin, end, count in zip(chunk.rows, chunk.first[:-1], chunk.first[1:], counts):
            if count:
                yield row, np.unique(grams[begin:begin + count])
            elif end > begin:
                yield row, np.array([short_hash(hashes[begin:end])], dtype=np.uint64)
            else:
                yield row, np.zeros(0, dtype=np.uint64)
