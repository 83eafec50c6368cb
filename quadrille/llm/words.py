"""Words and word shingles of whole texts as 64-bit hashes, for a slice of an Arrow batch at a time.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return, after lower-casing A-Z.  All work is on the UTF-8 bytes of the slice;
no Python object is made for a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[np.arange(65, 91)] = _BYTE[np.arange(97, 123)]
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = int(_RNG.integers(0, 2**62)) * 2 + 1
_PLACE = _RNG.integers(0, 2**63, 65, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = [
            np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))))
            for b in (_BASE, pow(_BASE, -1, 2**64))
        ]
    out = _POWERS[0][:n], _POWERS[1][:n]
    if len(_POWERS[0]) > 1 << 22:  # one very long text: don't keep its table
        _POWERS.clear()
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the offset of each value in them; a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each value the index of its first word (one more at the end)."""
    raw, offsets = text_bytes(column)
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    gap = _SEPARATOR[raw]
    starts = ~gap
    starts[1:] &= gap[:-1]
    ends = ~gap
    ends[:-1] &= gap[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    starts[edge] = ~gap[edge]
    ends[edge - 1] = ~gap[edge - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power, out=total[1:])
    h = mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return h, np.searchsorted(begin, offsets)


def shingles(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and for each value the index of its first one.

    A value with fewer words, but one at least, has its whole sequence as its only shingle.
    """
    h, first = words(column)
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
    out = np.zeros(int(offsets[-1]), np.uint64)
    if not len(out):
        return out, offsets
    at = np.arange(len(out)) - np.repeat(offsets[:-1] - first[:-1], n)  # index of the first word
    left = np.repeat(count, n)
    whole = left >= size
    for k in range(size):
        inside = whole | (k < left)
        out += np.where(inside, h[np.minimum(at + k, len(h) - 1)], np.uint64(0)) * _PLACE[k % 65]
    out += np.where(whole, np.uint64(size), left.astype(np.uint64)) * _PLACE[64]
    return mixed(out), offsets
