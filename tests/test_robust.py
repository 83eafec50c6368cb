"""Layouts, ids and points that once made wrong answers or all pairs."""

import time
import math
import random

import numpy as np
import pytest
import quadrille as qd
from pyspark.sql import Observation
from quadrille.functions.kernels import antipodal_pairs, farthest_of_ring
from quadrille.operators import rect_union as union_module
from quadrille.plans import grid


def sizes(boxes):
    count = {}
    for w, h in boxes:
        key = tuple(math.ceil(math.log2(v)) for v in (w, h))
        count[key] = count.get(key, 0) + 1
    return [(ex, ey, n) for (ex, ey), n in count.items()]


def test_mixed_sizes_keep_the_work_near_that_of_one_size():
    r = random.Random(1)
    tiny, ext = [(-10, -10, 1_000_000)], grid.Extents(1_000_000, 0, 0, 1000, 1000, 1.0)
    ext.sizes = tiny
    alone = grid.plan_layout(ext, ext)
    mixed = [(2.0 ** r.uniform(-10, 9), 2.0 ** r.uniform(-10, 9)) for _ in range(160)]
    both = grid.Extents(1_000_160, 0, 0, 1000, 1000, 1e6, tiny + sizes(mixed))
    layout = grid.plan_layout(both, both)
    assert layout.square and layout.base[0] <= alone.base[0] + 3
    work = grid._work(both, both, layout.base, layout.step, 0, layout.square)
    assert work < 50 * grid._work(ext, ext, alone.base, alone.step, 0, alone.square)


def test_an_outlier_does_not_coarsen_the_cells():
    ext = grid.Extents(2001, 0, 0, 1e15, 1e15, 2001.0, [(0, 0, 2001)])
    layout = grid.plan_layout(ext, ext)
    assert layout.base == grid.plan_layout(grid.Extents(2000, 0, 0, 1000, 1000, 2000.0, [(0, 0, 2000)]), None).base
    assert not layout.packed


def test_joins_of_mixed_sizes_and_outliers(spark, rects, points):
    r = random.Random(2)
    rows = [(i, x, y, x + 2.0 ** r.uniform(-6, 6), y + 2.0 ** r.uniform(-6, 6))
            for i, (x, y) in enumerate((r.uniform(0, 90), r.uniform(0, 90)) for _ in range(150))]
    rows += [(998, 1e15, 1e15, 1e15 + 1, 1e15 + 1), (999, -1e12, 5, -1e12 + 1, 6)]
    want = sorted(
        (a[0], b[0]) for a in rows for b in rows if a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]
    )
    frame = rects(rows)
    for strategy in ("broadcast", "shuffle"):
        assert sorted(map(tuple, qd.spatial_join(frame, frame, strategy=strategy).collect())) == want
    dots = [(i, r.uniform(0, 90), r.uniform(0, 90)) for i in range(200)] + [(1, 1e15, 1e15)]
    inside = {}
    for q in rows:
        n = sum(q[1] <= p[1] <= q[3] and q[2] <= p[2] <= q[4] for p in dots)
        if n:
            inside[q[0]] = n
    for strategy in ("broadcast", "shuffle", "cells"):
        assert dict(map(tuple, qd.spatial_count(points(dots), frame, strategy=strategy).collect())) == inside


def test_left_with_a_null_query_id(rects, points):
    q = rects([(1, 50.0, 50.0, 51.0, 51.0)]).unionByName(
        rects([(2, 0.0, 0.0, 2.0, 2.0)]).selectExpr("cast(null as long) id", "x1", "y1", "x2", "y2")
    )
    t = points([(7, 1.0, 1.0)])
    assert set(map(tuple, qd.spatial_count(t, q, how="left").collect())) == {(None, 1), (1, 0)}
    assert set(map(tuple, qd.spatial_join(t, q, how="left").collect())) == {(None, 7), (1, None)}
    lists = {r.qid: r.tids for r in qd.spatial_join(t, q, how="left", output="lists").collect()}
    assert lists == {None: [7], 1: []}


def test_coincident_points_in_many_partitions(points):
    rows = [(1.0, 2.0)] * 3300
    for parts in (4, 1100):
        assert [tuple(r) for r in qd.farthest_pair(points(rows, parts)).collect()] == [(1.0, 2.0, 1.0, 2.0, 0.0)]


def test_flat_rings_face_few_vertices():
    a = np.linspace(0, 2 * np.pi, 4000, endpoint=False)
    for aspect in (1.0, 1e17, 1e18):
        assert sum(len(i) for i, _ in antipodal_pairs(np.cos(a) * aspect, np.sin(a))) <= 6 * 4000


def test_pairs_of_a_ring_come_in_chunks():
    rng = np.random.default_rng(8)
    a = np.sort(rng.uniform(0, 2 * np.pi, 500))
    x, y = np.cos(a), np.sin(a)
    whole = [np.concatenate(c).tolist() for c in zip(*antipodal_pairs(x, y))]
    parts = list(antipodal_pairs(x, y, chunk=7))
    assert max(len(i) for i, _ in parts) == 7
    assert [np.concatenate(c).tolist() for c in zip(*parts)] == whole
    d2 = (x[:, None] - x) ** 2 + (y[:, None] - y) ** 2
    assert farthest_of_ring(x, y)[0] == d2.max()


def test_sql_predicates_take_any_two_corners(spark):
    qd.register_sql_functions(spark)
    row = spark.sql(
        "SELECT box_intersects(2,2,0,0, 3,3,1,1), box_contains(4,4,0,0, 2,2,1,1), box_within(2,1,1,2, 0,4,4,0),"
        " box_equals(0,0,1,1, 1,1,0,0), box_touches(1,1,0,0, 2,2,1,1), box_holds(4,4,0,0, 2,2,1,1), point_in_box(1,1, 2,2,0,0)"
    ).first()
    assert all(row)


def test_broadcast_has_a_bound():
    from types import SimpleNamespace

    from quadrille.operators import spatial_join as sj

    still = SimpleNamespace(isStreaming=False)
    for cells, side in ((sj._FORCED_ROWS, "queries"), (sj._FORCED_ROWS + 1, None)):
        assert sj.side_to_broadcast("broadcast", SimpleNamespace(query_cells=cells), still, None) == side
    with pytest.raises(ValueError):
        sj.side_to_broadcast("other", SimpleNamespace(query_cells=1), still, None)


def test_pockets_of_points_that_crowd_together(spark):
    rows = [(2.0**-k, 4.0**-k) for k in range(100)]
    began = time.time()
    got = {tuple(r) for r in qd.convex_hull(spark.createDataFrame(rows, "x double, y double"), one_task=3).collect()}
    assert got == set(rows)
    assert time.time() - began < 60


def crosses(lengths):
    """Boxes around one point, one for each way to be wider and lower than another."""
    return [(-a, -b, a, b) for a, b in zip(lengths, reversed(lengths))]


@pytest.mark.parametrize(
    "lengths",
    [[float(i) for i in range(1, 1200)], [2.0**-k for k in range(0, 900)], [1 + k * 2.0**-52 for k in range(400)]],
    ids=["even", "magnitudes", "neighbouring doubles"],
)
def test_union_of_boxes_through_one_point(rects, lengths):
    got = [tuple(r) for r in qd.rect_union(rects(crosses(lengths))).collect()]
    up = sorted(lengths)
    outer = list(zip(up, reversed(up)))
    inner = list(zip(up[:-1], list(reversed(up))[1:]))
    want = {(sx * x, sy * y, "corner") for x, y in outer + inner for sx in (1, -1) for sy in (1, -1)}
    assert len(got) == len(want) and set(got) == want


def test_no_tile_stays_crowded(spark):
    """Twenty thousand boxes through one point; no tile, so no group of a join, is large."""
    n = 20_000
    df = spark.range(1, n).selectExpr(
        "cast(-id AS double) AS xmin", f"cast(id - {n} AS double) AS ymin",
        "cast(id AS double) AS xmax", f"cast({n} - id AS double) AS ymax",
    )
    tiles = union_module._tiles(df, union_module.grid.measure(df))
    assert tiles.groupBy("tx", "cy").count().agg({"count": "max"}).first()[0] <= union_module._TILE_LIMIT
    assert qd.rect_union(df).count() == 8 * n - 12


WINDOW = [(1, 0.0, 0.0, 9.0, 9.0)]
CHECKED = {
    "range_query": lambda p, r, **o: qd.range_query(p, (0, 0, 9, 9), **o),
    "spatial_join": lambda p, r, **o: qd.spatial_join(p, r(WINDOW), **o),
    "spatial_count": lambda p, r, **o: qd.spatial_count(p, r(WINDOW), **o),
    "convex_hull": lambda p, r, **o: qd.convex_hull(p, **o),
    "farthest_pair": lambda p, r, **o: qd.farthest_pair(p, **o),
    "closest_pair": lambda p, r, **o: qd.closest_pair(p, **o),
    "rect_union": lambda p, r, **o: qd.rect_union(
        p.selectExpr("x AS x1", "y AS y1", "x + 1 AS x2", "y + 1 AS y2"), **o
    ),
}


@pytest.mark.parametrize("name", CHECKED)
def test_bad_rows_are_counted_or_refused(points, rects, name):
    good = [(1, 1.0, 1.0), (2, 4.0, 2.0), (3, 2.0, 7.0)]
    clean, mixed = points(good), points([*good, (4, math.nan, 1.0), (5, 2.0, math.inf)], 2)
    want = sorted(map(tuple, CHECKED[name](clean, rects, on_bad="fail").collect()))
    seen = Observation()
    assert sorted(map(tuple, CHECKED[name](mixed, rects, observation=seen).collect())) == want
    assert seen.get == {"bad_rows": 2, "rows": 5}
    with pytest.raises(ValueError, match="2 rows with bad coordinates"):
        CHECKED[name](mixed, rects, on_bad="fail")
    with pytest.raises(ValueError, match="'drop' or 'fail'"):
        CHECKED[name](mixed, rects, on_bad="keep")


def test_bad_queries_are_counted_or_refused(points, rects):
    p, q = points([(1, 1.0, 1.0)]), rects([*WINDOW, (2, 0.0, math.nan, 1.0, 1.0)])
    for operator in (qd.spatial_join, qd.spatial_count):
        seen = Observation()
        assert len(operator(p, q, query_observation=seen).collect()) == 1
        assert seen.get == {"bad_rows": 1, "rows": 2}
        with pytest.raises(ValueError, match="1 rows"):
            operator(p, q, on_bad="fail")
