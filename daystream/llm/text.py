"""Byte-level text helpers on whole Arrow columns (numpy, no per-word Python).

A word is a run of bytes other than 0x20 and 0x09-0x0D, as in every contract
of this package; UTF-8 continuation bytes are never in that set, so working on
bytes and on code points gives the same words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_RNG = np.random.default_rng(20240101)
#: Two independent random tables; a hash of this package is a function of them.
BYTE_VALUE = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (murmur-style finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
    body = col.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def release() -> None:
    """Give freed memory back to the machine: a Python worker lives on after its
    task, and what its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def pieces(table, column: str, most: int = 1 << 20) -> Iterator:
    """Consecutive row slices of about ``most`` bytes of ``column`` each.

    A row is never cut, so a longer text makes a slice of its own and the
    memory of a task follows its longest text.
    """
    n = table.num_rows
    if not n:
        return
    col = table.column(column).cast(pa.large_binary()).fill_null(b"")
    import pyarrow.compute as pc
    size = pc.binary_length(col).to_numpy()
    end = np.cumsum(size)
    at = 0
    while at < n:
        base = end[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(end, base + most, side="right")))
        yield table.slice(at, to - at)
        at = to
    release()


def words(data: np.ndarray, off: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word, in order; ``between`` marks the bytes that are in no word."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def _powers(n: int, which: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:
    have = cache.get(which)
    if have is None or len(have[0]) < n:
        m = max(n, 1 << 20)
        b = BASE[which]
        inv = np.uint64(pow(int(b), -1, 1 << 64))
        p = np.full(m, b, np.uint64)
        q = np.full(m, inv, np.uint64)
        p[0] = q[0] = 1
        have = np.cumprod(p), np.cumprod(q)
        if m <= 1 << 22:
            cache[which] = have
    return have


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of each byte range [start, end); equal bytes, equal hash."""
    n = len(data)
    p, q = _powers(n + 1, which)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[which][data] * p[:n], out=s[1:])
    return mix((s[end] - s[start]) * q[start])


def row_counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def slides(x: np.ndarray, w: int, of) -> np.ndarray:
    """``of`` (np.minimum or np.maximum) over every ``w`` consecutive values."""
    done = 1
    while done * 2 <= w:
        x = of(x[:-done], x[done:])
        done *= 2
    return of(x[:len(x) - (w - done)], x[w - done:]) if done < w else x


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All start[i] .. start[i]+length[i]-1, one after another."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length)
    return at + np.arange(total)


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Mask of the positions below ``n`` that lie in some [lo, hi)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, lo, 1)
    np.add.at(d, hi, -1)
    return np.cumsum(d[:-1]) > 0
