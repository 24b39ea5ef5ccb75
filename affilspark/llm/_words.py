"""Words of whole texts as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. All helpers work on one block of
an Arrow string column at a time (a few MB), so a task holds a block and never a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that equal low bits of polynomial hashes do not stay equal."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def blocks(column: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the number of its first word (one more at the end).

    breaks: more places (bytes) where a word ends and the next begins.
    """
    word = ~SPACE[data]
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    finish = word.copy()
    finish[:-1] &= ~word[1:]
    cut = offsets[1:-1] if breaks is None else np.concatenate([offsets[1:-1], breaks])
    cut = cut[(cut > 0) & (cut < len(word))]
    begin[cut] = word[cut]
    finish[cut - 1] = word[cut - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n at least."""
    if len(_powers[0]) <= n:
        size = 1 << int(n).bit_length()
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for k, b in enumerate((BASE, inverse)):
            x = np.full(size + 1, b, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: a polynomial over prefix sums, then mixed."""
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbours, by doubling; len(h)-k+1 values."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    cur, size, power = h, 1, int(BASE)
    out, have = None, 0
    while True:
        if k & 1:
            if out is None:
                out, have = cur, size
            else:
                n = len(h) - have - size + 1
                out = out[:n] * np.uint64(power) + cur[have : have + n]
                have += size
        k >>= 1
        if not k:
            return out
        n = len(h) - 2 * size + 1
        cur = cur[:n] * np.uint64(power) + cur[size : size + n]
        power, size = power * power % (1 << 64), size * 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, by doubling."""
    n, size, cur = len(x) - w + 1, 1, x
    if n <= 0:
        return x[:0]
    while size * 2 <= w:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    return np.minimum(cur[:n], cur[w - size : w - size + n])


def whole(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows of k words over a block: the numbers of those that lie in one row, and their rows."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), np.maximum(n - k + 1, 0))
    count = np.maximum(n - k + 1, 0)
    begin = np.cumsum(count) - count
    return np.arange(len(rows)) - np.repeat(begin, count) + first[:-1][rows], rows
