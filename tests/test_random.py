"""Random inputs on small lattices against plain Python, and invariants."""

import random

import numpy as np
import pytest

import brute
import quadrille as qd
from quadrille.functions import kernels
from quadrille.operators import closest_pair as closest_module
from quadrille.operators import rect_union as union_module
from quadrille.plans import grid


def lattice_points(rng, n, m):
    return [(float(rng.randrange(m)), float(rng.randrange(m))) for _ in range(n)]


def boxes(rng, n, m):
    out = []
    for _ in range(n):
        x, y = rng.randrange(m), rng.randrange(m)
        out.append((float(x), float(y), float(x + rng.randint(-4, 9)), float(y + rng.randint(-2, m))))
    return out


def test_kernels_on_many_lattices():
    rng = random.Random(1)
    for _ in range(400):
        pts = lattice_points(rng, rng.randint(1, 9), rng.randint(1, 8))
        x, y = (np.array(c) for c in zip(*pts))
        hx, hy = kernels.hull_ring(x, y)
        assert sorted(zip(hx.tolist(), hy.tolist())) == brute.hull(pts)
        near = kernels.closest_in(x, y)
        assert (near and near[1:]) == brute.pair(pts, farthest=False)
        far = kernels.farthest_of_ring(hx, hy)
        if len(set(pts)) > 1:
            assert far[1:] == brute.pair(pts, farthest=True)


def test_turn_is_exact():
    third = 1 / 3
    assert kernels.turn(0, 0, third, third, 1, 1) == 0
    assert kernels.turn(0, 0, 1e-200, 1, 2e-200, 2) == 0
    assert kernels.turn(0, 0, 1e16, 1e16 + 2, 2e16, 2e16 + 8) > 0


@pytest.mark.parametrize("seed", range(2))
def test_join_and_count(points, rects, monkeypatch, seed):
    rng = random.Random(seed)
    q, t = boxes(rng, 40, 30), boxes(rng, 60, 30)
    p = lattice_points(rng, 80, 40)
    qs, ts = rects([(i, *b) for i, b in enumerate(q)]), rects([(i, *b) for i, b in enumerate(t)])
    ps = points([(i, *c) for i, c in enumerate(p)], 3)
    met = sorted((i, j) for i, a in enumerate(q) for j, b in enumerate(t) if brute.meets(a, b))
    hit = sorted((i, j) for i, a in enumerate(q) for j, c in enumerate(p) if brute.meets(a, c + c))
    held = {}
    for i, a in enumerate(q):
        n = sum(brute.held(a, b) for b in t)
        if n:
            held[i] = n
    monkeypatch.setattr(grid, "_HOT_TARGETS", 5)
    monkeypatch.setattr(grid, "_HOT_QUERIES", 3)
    for strategy in ("broadcast", "shuffle"):
        assert sorted(map(tuple, qd.spatial_join(ts, qs, strategy=strategy).collect())) == met
        assert sorted(map(tuple, qd.spatial_join(ps, qs, strategy=strategy).collect())) == hit
        assert dict(map(tuple, qd.spatial_count(ts, qs, strategy=strategy).collect())) == held
    per_query = {i: sum(1 for a, _ in hit if a == i) for i, _ in hit}
    for strategy in ("shuffle", "cells"):
        assert dict(map(tuple, qd.spatial_count(ps, qs, strategy=strategy).collect())) == per_query


@pytest.mark.parametrize("seed", range(2))
def test_sizes_over_many_magnitudes(points, rects, seed):
    rng = random.Random(seed)

    def any_box():
        x, y = rng.uniform(0, 100), rng.uniform(-1e6, 1e6)
        return x, y, x + 2.0 ** rng.randint(-20, 8), y + rng.choice([0, 1e-3, 1.0, 1e5])

    q, t = [any_box() for _ in range(150)], [any_box() for _ in range(150)]
    p = [(b[0], b[1]) for b in q[:50]] + [(b[2], b[3]) for b in t]
    qs, ts = rects([(i, *b) for i, b in enumerate(q)]), rects([(i, *b) for i, b in enumerate(t)])
    ps = points([(i, *c) for i, c in enumerate(p)])
    met = sorted((i, j) for i, a in enumerate(q) for j, b in enumerate(t) if brute.meets(a, b))
    hit = sorted((i, j) for i, a in enumerate(q) for j, c in enumerate(p) if brute.meets(a, c + c))
    assert sorted(map(tuple, qd.spatial_join(ts, qs).collect())) == met
    assert sorted(map(tuple, qd.spatial_join(ps, qs).collect())) == hit
    n = sum(r.n for r in qd.spatial_count(ps, qs, strategy="cells").collect())
    assert n == len(hit)


@pytest.mark.parametrize("seed", range(2))
def test_pairs_and_hull_do_not_depend_on_the_cut(points, monkeypatch, seed):
    rng = random.Random(seed)
    pts = [(float(rng.randrange(10**6)), float(rng.randrange(10**6))) for _ in range(300)]
    if seed:
        pts = [(x % 3, y) for x, y in pts]  # many equal x: strips are cut along y
    near, far = brute.pair(pts, False), brute.pair(pts, True)
    hx, hy = kernels.hull_ring(*(np.array(c) for c in zip(*pts)))
    hull = sorted(zip(hx.tolist(), hy.tolist()))
    monkeypatch.setattr(closest_module, "_SWEEP", 16)
    monkeypatch.setattr(closest_module, "_ROWS_PER_STRIP", 20)
    for parts in (1, 5):
        df = points(pts, parts)
        assert tuple(qd.closest_pair(df, strips=parts + 1).first())[:4] == near
        assert tuple(qd.farthest_pair(df).first())[:4] == far
        assert [tuple(r) for r in qd.convex_hull(df).collect()] == hull


def test_hot_copies_settle_the_closest_pair(points, monkeypatch):
    monkeypatch.setattr(closest_module, "_ROWS_PER_STRIP", 50)
    df = points([(5.0, 5.0)] * 60 + [(float(i), float(i * i)) for i in range(100, 180)], 4)
    assert tuple(qd.closest_pair(df).first()) == (5.0, 5.0, 5.0, 5.0, 0.0)


@pytest.mark.parametrize("share", [1, 40])
def test_copies_are_folded_before_their_shuffle(points, monkeypatch, share):
    """A point in every ``share``-th row leaves each task twice, not n / share times."""
    monkeypatch.setattr(closest_module, "_SWEEP", 64)
    monkeypatch.setattr(closest_module, "_ROWS_PER_STRIP", 100)
    rng = random.Random(share)
    pts = [(3.0, -0.0) if i % share == 0 else (3.0 + rng.random(), rng.random()) for i in range(2000)]
    pts += [(2.0, 9.0), (2.0, 9.0), (2.0, 8.0), (1.0, 1.0)]
    rng.shuffle(pts)
    df = points(pts, 4)
    folded = df.mapInArrow(closest_module._fold_copies, "x double, y double")
    assert folded.where("x = 3 AND y = 0").count() <= 8
    assert tuple(qd.closest_pair(df).first()) == (2.0, 9.0, 2.0, 9.0, 0.0)
    alone = points([p for p in pts if p[0] != 2.0], 4)
    assert tuple(qd.closest_pair(alone).first()) == (3.0, 0.0, 3.0, 0.0, 0.0)


def test_large_hull_is_finished_piecewise(points):
    rng = np.random.default_rng(4)
    a = rng.uniform(0, 2 * np.pi, 300)
    pts = list(zip((np.cos(a) * 100).tolist(), (np.sin(a) * 100).tolist()))
    hx, hy = kernels.hull_ring(*(np.array(c) for c in zip(*pts)))
    df = points(pts, 3)
    got = [tuple(r) for r in qd.convex_hull(df, one_task=80).collect()]
    assert got == sorted(zip(hx.tolist(), hy.tolist()))
    assert tuple(qd.farthest_pair(df, one_task=80).first())[:4] == brute.pair(pts, True)


@pytest.mark.parametrize(("seed", "limit"), [(0, 64), (1, 4), (2, 8), (3, 3)])
def test_union_against_raster(rects, monkeypatch, seed, limit):
    monkeypatch.setattr(union_module, "_TILE_LIMIT", limit)
    rng = random.Random(seed)
    given = boxes(rng, 25, 14)
    got = [tuple(r) for r in qd.rect_union(rects(given)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.outline(given)


def test_union_does_not_change_when_a_box_is_split(rects):
    corners = {tuple(r) for r in qd.rect_union(rects([(0, 0, 8, 6), (5, 5, 9, 9)]), corners_only=True).collect()}
    split = [(0, 0, 3, 6), (3, 0, 8, 2), (3, 2, 8, 6), (5, 5, 9, 9)]
    assert {tuple(r) for r in qd.rect_union(rects(split), corners_only=True).collect()} == corners


def test_stack_of_shifted_boxes(rects):
    """Crowded boxes that hide each other: tiles inside a box are dropped."""
    rng = random.Random(9)
    given = [(rng.randrange(40), rng.randrange(40)) for _ in range(400)]
    given = [(float(x), float(y), float(x + 100), float(y + 100)) for x, y in given]
    got = [tuple(r) for r in qd.rect_union(rects(given)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.outline(given)
