"""Vectorised byte-level text helpers for Arrow batches.

A string column is used as its UTF-8 buffer plus offsets, never as Python
strings. White space (0x20, 0x09-0x0D) and line ends are single ASCII bytes, so
words and lines found on bytes are the words and lines of the text. Batches are
cut into slices of about a megabyte, so memory does not follow the batch size
(one longer text makes one longer slice).

Hashes of byte runs are polynomial prefix hashes modulo 2^64 over a random
value per byte, finished with a bit mixer: any word, line or window costs O(1).
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

U64 = np.uint64
SLICE_BYTES = 1 << 20

_MUL1, _MUL2, _GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C55 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_GRAM = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * _MUL1
    x = (x ^ (x >> U64(27))) * _MUL2
    return x ^ (x >> U64(31))


BYTE_VALUE = mix((np.arange(256, dtype=U64) + U64(1)) * _GOLD)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(max(n, SLICE_BYTES + 1), base, U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    got = _powers[0][:n], _powers[1][:n]
    if n > 8 * SLICE_BYTES:  # an unusually long text: do not keep its table
        _powers[:] = [np.ones(1, U64), np.ones(1, U64)]
    return got


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive row runs of at most ``limit`` bytes (one row at least)."""
    raw, offs = buffer_of(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
        yield lo, hi, raw[offs[lo]: offs[hi]], offs[lo: hi + 1] - offs[lo]
        lo = hi


def give_back() -> None:
    """Returns the memory that a finished task has freed to the system: workers live on and serve other stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross a text's end: (starts, ends, text index)."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


class Hasher:
    """Prefix hash of one slice; ``of(starts, ends)`` hashes byte runs."""

    def __init__(self, raw: np.ndarray, values: np.ndarray = BYTE_VALUE):
        n = len(raw)
        self.pow, self.inv = _power(n + 1)
        self.sum = np.zeros(n + 1, U64)
        np.cumsum(values[raw] * self.pow[:n], out=self.sum[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sum[ends] - self.sum[starts]) * self.inv[starts] + (ends - starts).astype(U64) * _GOLD)


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of True flags (or sum) between consecutive offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def word_counts(text_of: np.ndarray, n_texts: int) -> np.ndarray:
    return np.bincount(text_of, minlength=n_texts).astype(np.int64)


def grams(h: np.ndarray, text_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive items of one text: (hash, index of the first item)."""
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    g = h[:m].copy()
    for k in range(1, n):
        g *= _GRAM
        g += h[k: k + m]
    at = np.flatnonzero(text_of[:m] == text_of[n - 1:])
    return mix(g[at]), at


def in_text(h: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Key that differs between texts for the same hash (to group by (text, hash) in one sort)."""
    return mix(h + (text_of.astype(U64) + U64(1)) * _GOLD)


def repeated(key: np.ndarray) -> np.ndarray:
    """True where the key occurs twice or more."""
    out = np.zeros(len(key), bool)
    if len(key) > 1:
        order = np.argsort(key)
        s = key[order]
        same = s[1:] == s[:-1]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out
