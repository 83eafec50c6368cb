"""Words of a slice of texts as byte spans with 64-bit hashes; A-Z are lower-cased."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quadrille.llm.words import _BYTE, _powers, mixed, text_bytes

_RNG = np.random.Generator(np.random.PCG64(20251130))
_PLACE = _RNG.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_set(*values: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


@dataclass
class Spans:
    """``raw[begin:end]`` is a word, ``first`` the index of each value's first word (one more at the end)."""

    raw: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    piece: np.ndarray  # words of one piece are contiguous and carry its number

    def value(self) -> np.ndarray:
        """Number of the value each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.raw[self.begin[i] : self.end[i]].tobytes()


def spans(column: pa.Array, separators: np.ndarray, breaks: np.ndarray | None = None, longest: int | None = None) -> Spans:
    """Words between ``separators`` and ``breaks`` (256 flags each); a break or a new value begins a piece.

    ``longest`` cuts longer words into runs of so many bytes, so that a text without any
    separator is words of bounded size as well.
    """
    raw, offsets = text_bytes(column)
    raw = _LOWER[raw]
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return Spans(raw, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64), none)
    stop = separators if breaks is None else separators | breaks
    gap = stop[raw]
    starts, ends = ~gap, ~gap
    starts[1:] &= gap[:-1]
    ends[:-1] &= gap[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    starts[edge] = ~gap[edge]
    ends[edge - 1] = ~gap[edge - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if longest is not None and len(begin) and (end - begin).max() > longest:
        parts = -(-(end - begin) // longest)
        own = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, end = np.repeat(begin, parts) + own * longest, np.repeat(end, parts)
        end = np.minimum(end, begin + longest)
    power, inverse = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power, out=total[1:])
    hashes = mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    first = np.searchsorted(begin, offsets)
    if breaks is None:
        piece = np.zeros(len(begin), np.int64)
    else:
        piece = np.concatenate((np.zeros(1, np.int64), np.cumsum(breaks[raw])))[begin]
    piece = piece + np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Spans(raw, begin, end, first, hashes, piece)


def grams(
    hashes: np.ndarray, piece: np.ndarray, size: int, begin: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of every run of ``size`` words inside a piece; ``begin``: only from there."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if begin is None:
        at = np.flatnonzero(piece[:n] == piece[size - 1 :])
    else:
        begin = begin[begin < n]
        at = begin[piece[begin] == piece[begin + size - 1]]
    out = np.full(len(at), size, np.uint64) * _PLACE[7]
    for k in range(size):
        out += hashes[at + k] * _PLACE[k]
    return at, mixed(out)
