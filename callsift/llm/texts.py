"""Texts of an Arrow column as flat bytes, and hashes of their words and shingles.

Everything works on one slice of a batch at a time, so memory follows the slice
and not the table. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def _trim():
    """glibc's malloc_trim, or nothing where the C library has none."""
    try:
        return ctypes.CDLL(ctypes.util.find_library("c")).malloc_trim
    except (OSError, AttributeError, TypeError):
        return lambda _: 0


_malloc_trim = _trim()


def give_back() -> None:
    """Hands memory that Arrow's pool and malloc keep free back to the system.

    A Python worker serves the tasks of later stages too; without this it keeps the
    peak of its largest batch (about half of it free) while others run.
    """
    pa.default_memory_pool().release_unused()
    _malloc_trim(0)


def giving_back(batches: Iterator) -> Iterator:
    """The batches as they come; when they end, ``give_back``."""
    yield from batches
    give_back()

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit value for each byte.
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64."""
    have = _powers.get(name)
    if have is None or len(have) <= n:
        grown = np.full(max(n + 1, SLICE_BYTES + 1), base, np.uint64)
        grown[0] = 1
        have = _powers[name] = np.cumprod(grown)
    return have


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts after one another, and where each begins."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``most`` bytes of text; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Rolling:
    """Hashes of any substrings of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _power("inverse", _INVERSE, n)[:n], out=self._sums[1:])
        self._scale = _power("base", _BASE, n)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One value a substring, whatever its place."""
        return mix((self._sums[ends] - self._sums[starts]) * self._scale[starts])

    def every(self, width: int) -> np.ndarray:
        """One value for each substring of ``width`` bytes."""
        n = len(self._sums) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self._sums[width:] - self._sums[:n]) * self._scale[:n])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and each text's first word."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~WHITE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edge] = inside[edge]
    edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    ASCII letters count as lower case. A text of fewer words is one shingle; a
    text without words has none.
    """
    data, offsets = flat(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    word = Rolling(data).of(starts, ends) if len(starts) else np.empty(0, np.uint64)
    every = np.zeros(max(len(word) - width + 1, 0), np.uint64)
    for k in range(width):
        every = every * _STEP + word[k : k + len(every)]
    every = mix(every)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in word[a:b]:
                    whole = whole * _STEP + x
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.empty(0, np.uint64)
