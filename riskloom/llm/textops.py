"""Words of UTF-8 text as 64-bit hashes, straight from Arrow string buffers.

A word is a maximal run of bytes other than space and \\x09-\\x0D.  Its hash is
a polynomial in an odd multiplier, taken from running sums over a stretch of
bytes, so a whole batch needs a handful of array operations and no string
objects.  Memory is bounded by the stretch (``STRETCH`` bytes, or the longest
word), not by the batch or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STRETCH = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Byte -> byte with A-Z lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Odd multiplier of the polynomial and its inverse modulo 2^64.
_BASE = 0x9E6C63D0876A3F6B
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, STRETCH + 1), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, length) of the words in ``data``; ``breaks`` are offsets at which a word ends in any case."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[breaks] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    size = ends - starts
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + size.astype(np.uint64)), starts, size


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def stretches(off: np.ndarray, limit: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def row_words(raw: np.ndarray, off: np.ndarray, lo: int, hi: int,
              fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, byte lengths, words per row) for rows lo..hi, bytes first mapped
    by ``fold``; a row longer than a stretch is hashed piece by piece, cut at white space."""
    if off[hi] - off[lo] <= STRETCH or hi > lo + 1:
        data = raw[off[lo]:off[hi]]
        hashes, starts, size = _hash_words(data if fold is None else fold[data], off[lo:hi + 1] - off[lo])
        per_row = np.diff(np.searchsorted(starts, off[lo:hi + 1] - off[lo]))
        return hashes, size, per_row
    found, at, end = [], int(off[lo]), int(off[hi])
    while at < end:
        to, width = min(at + STRETCH, end), STRETCH
        while to < end:
            gaps = np.flatnonzero(_SPACE[raw[max(at, to - width):to]])
            if len(gaps):
                to = max(at, to - width) + int(gaps[-1]) + 1
                break
            if width > STRETCH:
                width *= 2
            to = min(to + STRETCH, end)
            width += STRETCH
        data = raw[at:to]
        found.append(_hash_words(data if fold is None else fold[data], np.zeros(0, np.int64)))
        at = to
    hashes = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
    size = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
    return hashes, size, np.array([len(hashes)])
