"""Vectorised scans over the bytes of an Arrow string column.

A string column is one UTF-8 buffer with offsets, so words, lines and n-gram
hashes of thousands of texts come from a few numpy passes, without a Python
loop over texts.  Work goes in slices of a few MB to bound memory; a longer
text makes a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) pieces of a string array; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, data[off[at] : off[end]], (off[at : end + 1] - off[at])
        at = end
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64 constants) of a uint64 array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """n pseudo-random odd 64-bit multipliers, the same on every machine."""
    i = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(i + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))) | np.uint64(1)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of data[start:end] for disjoint, ordered, non-empty spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    pos = np.arange(total, dtype=np.int64) - np.repeat(first, lens)
    src = pos + np.repeat(starts, lens)
    mult = multipliers(int(lens.max()), seed)
    prod = (data[src].astype(np.uint64) + np.uint64(1)) * mult[pos]
    return mix(np.add.reduceat(prod, first) + lens.astype(np.uint64))


#: ASCII letters in lower case; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes that separate alphanumeric tokens: ASCII other than letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(data: np.ndarray, off: np.ndarray, gaps: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the runs of bytes that ``gaps`` does not mark (ASCII white space)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~gaps[data]
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    edge = off[1:-1]
    edge = edge[edge < n]
    begin[edge] = ink[edge]
    stop = ink.copy()
    stop[:-1] &= ~ink[1:]
    last = edge[edge > 0] - 1
    stop[last] = ink[last]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set bytes per row."""
    c = np.concatenate([[0], np.cumsum(mask)])
    return c[off[1:]] - c[off[:-1]]


def windows(word_hash: np.ndarray, row: np.ndarray, width: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``width`` words inside one row."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    mult = multipliers(width, seed)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += word_hash[k : k + n] * mult[k]
    at = np.flatnonzero(row[:n] == row[width - 1 : width - 1 + n])
    return mix(total[at]), at


def repeated(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(occurs twice or more in its row, equals an earlier one of its row) per item, in item order."""
    n = len(key)
    twice, later = np.zeros(n, bool), np.zeros(n, bool)
    if n < 2:
        return twice, later
    order = np.lexsort((key, row))  # stable: items of one key stay in text order
    r, k = row[order], key[order]
    same = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    later[order[1:]] = same
    both = np.zeros(n, bool)
    both[1:] |= same
    both[:-1] |= same
    twice[order] = both
    return twice, later
