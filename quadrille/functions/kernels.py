"""Small numpy helpers that run inside Spark tasks on Arrow batches.

Spark decides which points meet in a task; these helpers only reduce the points
of one task.  Turns are decided exactly: a double determinant with an error
bound, and rational arithmetic when the bound cannot tell.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np

# Error of the double 2x2 determinant relative to the sum of its two products.
_DET_ERROR = (3.0 + 16.0 * 2.0**-53) * 2.0**-53


def turn(ax: float, ay: float, bx: float, by: float, cx: float, cy: float) -> float:
    """Positive for a left turn a-b-c, negative for a right turn, 0 on a line."""
    if (bx == ax or cy == ay) and (by == ay or cx == ax):
        return 0.0
    left, right = (bx - ax) * (cy - ay), (by - ay) * (cx - ax)
    det = left - right
    if abs(det) > _DET_ERROR * (abs(left) + abs(right)):
        return det
    ax, ay, bx, by, cx, cy = (Fraction(v) for v in (ax, ay, bx, by, cx, cy))
    det = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (det > 0) - (det < 0)


def _chain(xs: list[float], ys: list[float]) -> list[int]:
    """Lower chain of points sorted by x, y."""
    out: list[int] = []
    for i in range(len(xs)):
        while len(out) > 1 and (
            turn(xs[out[-2]], ys[out[-2]], xs[out[-1]], ys[out[-1]], xs[i], ys[i]) <= 0
        ):
            out.pop()
        out.append(i)
    return out


def _drop_inner(x: np.ndarray, y: np.ndarray, directions: int = 16) -> np.ndarray:
    """Mask of the points that are not surely inside the polygon of extremes."""
    span_x, span_y = np.ptp(x), np.ptp(y)
    if not (span_x > 0 and span_y > 0 and np.isfinite(span_x) and np.isfinite(span_y)):
        return np.ones(len(x), dtype=bool)
    u, v = (x - x.min()) / span_x, (y - y.min()) / span_y
    ring: list[int] = []
    for a in np.arange(directions) * (2 * np.pi / directions):
        i = int(np.argmax(np.cos(a) * u + np.sin(a) * v))
        if not ring or (x[i], y[i]) != (x[ring[-1]], y[ring[-1]]):
            ring.append(i)
    if len(ring) > 1 and (x[ring[0]], y[ring[0]]) == (x[ring[-1]], y[ring[-1]]):
        ring.pop()
    inside = np.ones(len(x), dtype=bool)
    if len(ring) < 3:
        return inside
    for i, j in zip(ring, ring[1:] + ring[:1]):
        left = (x[j] - x[i]) * (y - y[i])
        right = (y[j] - y[i]) * (x - x[i])
        inside &= (left - right) > _DET_ERROR * (np.abs(left) + np.abs(right))
    return ~inside


def hull_ring(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strict hull vertices counter-clockwise, starting at the smallest (x, y)."""
    if len(x) > 64:
        keep = _drop_inner(x, y)
        x, y = x[keep], y[keep]
    if len(x) == 0:
        return x, y
    order = np.lexsort((y, x))
    x, y = x[order] + 0.0, y[order] + 0.0  # + 0.0 turns -0.0 into 0.0
    fresh = np.ones(len(x), dtype=bool)
    fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    x, y = x[fresh], y[fresh]
    if len(x) < 3:
        return x, y
    xs, ys = x.tolist(), y.tolist()
    lower = _chain(xs, ys)
    upper = _chain(xs[::-1], ys[::-1])
    last = len(xs) - 1
    ring = lower[:-1] + [last - i for i in upper[:-1]]
    return x[ring], y[ring]


def antipodal_pairs(
    x: np.ndarray, y: np.ndarray, chunk: int = 1 << 20
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a hull ring among which the farthest pair is found, ``chunk`` at a time.

    Vertex i faces the directions between its two edges; its partners face the
    opposite directions.  Ranges are widened by one vertex on both ends.
    """
    n = len(x)
    if n < 4:
        yield np.triu_indices(n, 1)
        return
    # parallel lines stay parallel when an axis is scaled, and a flat ring keeps its angles apart
    width, height = max(np.ptp(x), np.finfo(float).tiny), max(np.ptp(y), np.finfo(float).tiny)
    angle = np.unwrap(np.arctan2((np.roll(y, -1) - y) / height, (np.roll(x, -1) - x) / width))
    angle = np.maximum.accumulate(angle)
    wrapped = np.concatenate([angle, angle + 2 * np.pi])
    before = np.roll(angle, 1)
    before[0] -= 2 * np.pi
    lo = np.searchsorted(wrapped, before + np.pi, "left") - 1
    hi = np.searchsorted(wrapped, angle + np.pi, "right") + 1
    ends = np.cumsum(hi - lo + 1)
    for begin in range(0, int(ends[-1]), chunk):
        pair = np.arange(begin, min(begin + chunk, int(ends[-1])))
        i = np.searchsorted(ends, pair, "right")
        yield i, (hi[i] - (ends[i] - 1 - pair)) % n


def farthest_of_ring(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float, float, float] | None:
    """(d2, x1, y1, x2, y2) of the farthest vertices; memory grows with the ring, not with its pairs."""
    found = (best_pair(x[i], y[i], x[j], y[j], farthest=True) for i, j in antipodal_pairs(x, y))
    return min((f for f in found if f is not None), key=lambda f: (-f[0], *f[1:]), default=None)


def best_pair(
    x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, farthest: bool
) -> tuple[float, float, float, float, float] | None:
    """(d2, x1, y1, x2, y2) of the extreme pair; ties go to the smallest points."""
    if len(x1) == 0:
        return None
    dx, dy = x1 - x2, y1 - y2
    d2 = dx * dx + dy * dy
    best = d2.max() if farthest else d2.min()
    k = np.nonzero(d2 == best)[0]
    swap = (x1[k] > x2[k]) | ((x1[k] == x2[k]) & (y1[k] > y2[k]))
    ax, ay = np.where(swap, x2[k], x1[k]), np.where(swap, y2[k], y1[k])
    bx, by = np.where(swap, x1[k], x2[k]), np.where(swap, y1[k], y2[k])
    i = np.lexsort((by, bx, ay, ax))[0]
    return float(best), float(ax[i]), float(ay[i]), float(bx[i]), float(by[i])


def better(a: tuple | None, b: tuple | None) -> tuple | None:
    """The nearer of two pairs (d2, x1, y1, x2, y2)."""
    if a is None or b is None:
        return a or b
    return min(a, b)


def _cells(x: np.ndarray, y: np.ndarray, side: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cell = np.floor(x / side) + 1j * np.floor(y / side)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]
    return cell[first], np.append(np.nonzero(first)[0], len(cell)), order


def closest_in(x: np.ndarray, y: np.ndarray) -> tuple | None:
    """Nearest pair (d2, x1, y1, x2, y2) of the points of one task.

    A cell of side s that holds more than m*m points holds two of them within
    s*sqrt(2)/m, so s shrinks until no cell is crowded.  Then only neighbouring
    cells are compared: work grows with the number of points.
    """
    n = len(x)
    if n < 2:
        return None
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    same = np.nonzero((x[1:] == x[:-1]) & (y[1:] == y[:-1]))[0]
    if len(same):
        px, py = float(x[same[0]]), float(y[same[0]])
        return 0.0, px, py, px, py
    best = best_pair(x[:-1], y[:-1], x[1:], y[1:], farthest=False)
    side = float(np.sqrt(best[0])) * (1 + 1e-9)
    x0, y0 = x.min(), y.min()
    u, v = x - x0, y - y0
    while True:
        side = max(side, 1e-150)
        cells, start, order = _cells(u, v, side)
        crowd = int(np.diff(start).max())
        m = int(np.sqrt(crowd - 1))
        if m < 3:
            break
        side = side * np.sqrt(2.0) / m * (1 + 1e-9)
    px, py = x[order], y[order]
    count = np.diff(start)
    for offset in (0, 1j, 1 - 1j, 1 + 0j, 1 + 1j):
        at = np.searchsorted(cells, cells + offset)
        at[at == len(cells)] = 0
        a = np.nonzero(cells[at] == cells + offset)[0]
        b = at[a]
        for ia in range(int(count[a].max()) if len(a) else 0):
            fits = count[a] > ia
            a, b = a[fits], b[fits]
            bb, aa = b, a
            for ib in range(int(count[b].max()) if len(b) else 0):
                fits = count[bb] > ib
                aa, bb = aa[fits], bb[fits]
                i, j = start[aa] + ia, start[bb] + ib
                other = i != j
                i, j = i[other], j[other]
                best = better(best, best_pair(px[i], py[i], px[j], py[j], farthest=False))
    return best
