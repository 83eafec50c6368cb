"""Plain Python answers for small inputs."""

from __future__ import annotations

from itertools import combinations


def norm(b):
    return min(b[0], b[2]), min(b[1], b[3]), max(b[0], b[2]), max(b[1], b[3])


def meets(q, t):
    q, t = norm(q), norm(t)
    return q[0] <= t[2] and t[0] <= q[2] and q[1] <= t[3] and t[1] <= q[3]


def overlaps(q, t):
    q, t = norm(q), norm(t)
    return q[0] < t[2] and t[0] < q[2] and q[1] < t[3] and t[1] < q[3]


def held(q, t):
    q, t = norm(q), norm(t)
    inside = q[0] <= t[0] and t[2] <= q[2] and q[1] <= t[1] and t[3] <= q[3]
    return (inside and overlaps(q, t)) or (meets(q, t) and not overlaps(q, t))


def _turn(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def hull(points):
    pts = sorted(set(points))
    out = []
    for p in pts:
        rest = [q for q in pts if q != p]
        on_segment = any(_turn(a, b, p) == 0 and min(a, b) <= p <= max(a, b) for a, b in combinations(rest, 2))
        inside = any(
            all(s > 0 for s in turns) or all(s < 0 for s in turns)
            for a, b, c in combinations(rest, 3)
            for turns in [(_turn(a, b, p), _turn(b, c, p), _turn(c, a, p))]
        )
        if not on_segment and not inside:
            out.append(p)
    return out


def pair(points, farthest):
    best = None
    for a, b in combinations(sorted(points), 2):
        d2 = (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2
        key = (-d2 if farthest else d2, *a, *b)
        if best is None or key < best:
            best = key
    return best and best[1:]


def outline(rects):
    """Outline vertices of lattice rectangles by looking at the four unit cells
    around every lattice point."""
    rects = [norm(r) for r in rects]
    rects = [r for r in rects if r[0] < r[2] and r[1] < r[3]]
    full = {
        (i, j)
        for x1, y1, x2, y2 in rects
        for i in range(int(x1), int(x2))
        for j in range(int(y1), int(y2))
    }
    corners = {(x, y) for r in rects for x in (r[0], r[2]) for y in (r[1], r[3])}
    around = {(x + dx, y + dy) for x, y in full for dx in (0, 1) for dy in (0, 1)}
    out = set()
    for x, y in around:
        ne, nw, sw, se = (c in full for c in ((x, y), (x - 1, y), (x - 1, y - 1), (x, y - 1)))
        n = ne + nw + sw + se
        if n in (1, 3) or (n == 2 and ne == sw):
            out.add((x, y, "corner"))
        elif n == 2 and (x, y) in corners:
            out.add((x, y, "collinear"))
    return out
