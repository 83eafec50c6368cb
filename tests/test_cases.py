"""Hand-computed cases: borders, contacts, degenerate and empty inputs, ties."""

import pytest

import quadrille as qd
from quadrille.operators import rect_union as union_module

QUERY = (1, 0, 0, 2, 2)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_range_borders_and_reversed_corners(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 0.0), ("b", 4.0, 4.0), ("c", 2.0, 0.0), ("d", 2.0, 2.0), ("e", 4.1, 2.0),
         ("f", float("nan"), 1.0), ("g", None, 1.0)], "id string, x double, y double",
    )
    assert sorted(r.id for r in qd.range_query(df, (4, 4, 0, 0)).collect()) == ["a", "b", "c", "d"]
    assert [r.id for r in qd.range_query(df, (0, 0, 0, 0)).collect()] == ["a"]
    assert qd.range_query(df, (0, 0, 1, 1), columns=None).columns == ["id", "x", "y"]


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_join_contact_enclosing_and_order(rects, points, strategy):
    q = rects([(1, 0, 0, 2, 2), (2, 5, 5, 6, 6), (3, 10, 10, 11, 11)])
    t = rects([(10, 2, 2, 3, 3), (11, 1, 1, 5.5, 5.5)])
    lists = qd.spatial_join(t, q, output="lists", strategy=strategy)
    assert sorted(rows(lists)) == [(1, [10, 11]), (2, [11])]
    left = qd.spatial_join(t, q, how="left", output="lists", strategy=strategy)
    assert sorted(rows(left)) == [(1, [10, 11]), (2, [11]), (3, [])]
    pairs = qd.spatial_join(t, q, how="left", strategy=strategy)
    assert sorted(rows(pairs), key=str) == [(1, 10), (1, 11), (2, 11), (3, None)]
    assert rows(qd.spatial_join(rects([(5, 0, 0, 9, 9)]), rects([(1, 1, 1, 2, 2)]), strategy=strategy)) == [(1, 5)]
    twice = qd.spatial_join(points([(7, 0, 0), (7, 1, 1)]), rects([(1, 0, 0, 1, 1)]), output="lists", strategy=strategy)
    assert rows(twice) == [(1, [7, 7])]


def test_join_lines_are_ordered_by_number(rects, points):
    q = rects([(10, 0, 0, 1, 1), (2, 0, 0, 1, 1)])
    t = points([(10, 1, 1), (9, 0, 0)])
    lines = qd.to_lines(qd.spatial_join(t, q, output="lists")).collect()
    assert [r.value for r in lines] == ["2,9,10", "10,9,10"]


def test_long_lists_come_in_parts(rects, points):
    q = rects([(1, 0, 0, 9, 9), (2, 3, 3, 4, 4), (3, 50, 50, 51, 51)])
    t = points([(i, i / 10, i / 10) for i in range(60)])
    got = rows(qd.spatial_join(t, q, output="parts", part_size=15))
    assert all(ids == sorted(ids) for _, _, ids in got)
    assert sorted(i for qid, _, ids in got if qid == 1 for i in ids) == list(range(60))
    assert sum(qid == 1 for qid, _, _ in got) > 1
    assert [(part, len(ids)) for qid, part, ids in got if qid == 2] == [(0, 11)]
    left = qd.spatial_join(t, q, how="left", output="parts").select("qid", "part", "tids")
    assert [(part, ids) for qid, part, ids in rows(left) if qid == 3] == [(0, [])]


def test_degenerate_queries_and_targets_are_closed(rects, points):
    q = rects([(1, 1, 0, 1, 5), (2, 3, 3, 3, 3)])
    t = points([(1, 1, 2), (2, 3, 3), (3, 1.5, 2)])
    assert sorted(rows(qd.spatial_join(t, q))) == [(1, 1), (2, 2)]
    assert sorted(rows(qd.spatial_count(t, q))) == [(1, 1), (2, 1)]
    assert sorted(rows(qd.spatial_join(rects([(9, 0, 2, 4, 2)]), q))) == [(1, 9)]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle", "cells"])
def test_count_points(rects, points, strategy):
    t = points([(0, 0, 0), (1, 2, 1), (2, 1, 1), (3, 3, 3), (4, float("nan"), 1)])
    q = rects([QUERY, (2, 50, 50, 51, 51)])
    assert rows(qd.spatial_count(t, q, strategy=strategy)) == [(1, 3)]
    assert sorted(rows(qd.spatial_count(t, q, how="left", strategy=strategy))) == [(1, 3), (2, 0)]


def test_count_rects_inside_or_touching_only(rects):
    t = rects([(1, 0.5, 0.5, 1, 1), (2, 2, 2, 3, 3), (3, 1, 1, 3, 3), (4, -1, -1, 3, 3)])
    assert rows(qd.spatial_count(t, rects([QUERY]))) == [(1, 2)]


def test_repeated_query_ids_add_up(rects, points):
    q = rects([QUERY, QUERY])
    assert rows(qd.spatial_count(points([(0, 1, 1)]), q)) == [(1, 2)]
    assert rows(qd.spatial_join(points([(0, 1, 1)]), q, output="lists")) == [(1, [0, 0])]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ([(0, 0), (4, 0), (4, 4), (0, 4), (2, 2), (2, 0), (4, 0)], [(0, 0), (0, 4), (4, 0), (4, 4)]),
        ([(0, 0), (1, 1), (3, 3), (2, 2)], [(0, 0), (3, 3)]),
        ([(1, 1), (1, 1)], [(1, 1)]),
        ([(2, 5), (2, 1), (2, 3)], [(2, 1), (2, 5)]),
        ([], []),
    ],
)
def test_hull(points, given, want):
    given = [(float(x), float(y)) for x, y in given]
    assert rows(qd.convex_hull(points(given, 3))) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ([(0, 0), (3, 4), (1, 1)], [(0, 0, 3, 4, 5.0)]),
        ([(0, 0), (1, 0), (1, 1), (0, 1)], [(0, 0, 1, 1, 2**0.5)]),
        ([(1, 1)], []),
        ([(1, 1), (1, 1)], [(1, 1, 1, 1, 0.0)]),
        ([], []),
    ],
)
def test_farthest(points, given, want):
    given = [(float(x), float(y)) for x, y in given]
    assert rows(qd.farthest_pair(points(given, 3))) == want


@pytest.mark.parametrize("strips", [None, 1, 3])
@pytest.mark.parametrize(
    ("given", "want"),
    [
        ([(0, 0), (10, 0), (10, 0.5), (3, 3)], [(10, 0, 10, 0.5, 0.5)]),
        ([(1, 1), (5, 5), (1, 1)], [(1, 1, 1, 1, 0.0)]),
        # the near pair lies in two parts and shares a coordinate with another pair
        ([(0, 0), (0, 1), (0, 5), (0, 5.5), (9, 9)], [(0, 5, 0, 5.5, 0.5)]),
        ([(7, 7)], []),
        ([(1, 2), (4, 6)], [(1, 2, 4, 6, 5.0)]),
        ([], []),
    ],
)
def test_closest(points, given, want, strips):
    given = [(float(x), float(y)) for x, y in given]
    assert rows(qd.closest_pair(points(given, 2), strips=strips)) == want


UNIONS = {
    "overlap": (
        [(0, 0, 2, 2), (1, 1, 3, 3)],
        [(0, 0), (0, 2), (1, 2), (1, 3), (2, 0), (2, 1), (3, 1), (3, 3)], [],
    ),
    "adjacent": ([(0, 0, 1, 1), (1, 0, 2, 1)], [(0, 0), (0, 1), (2, 0), (2, 1)], [(1, 0), (1, 1)]),
    "hole": (
        [(0, 0, 3, 1), (0, 2, 3, 3), (0, 0, 1, 3), (2, 0, 3, 3)],
        [(0, 0), (0, 3), (3, 0), (3, 3), (1, 1), (1, 2), (2, 1), (2, 2)],
        [(0, 1), (0, 2), (1, 0), (1, 3), (2, 0), (2, 3), (3, 1), (3, 2)],
    ),
    "corner contact": (
        [(0, 0, 1, 1), (1, 1, 2, 2)],
        [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 1), (2, 2)], [],
    ),
    "contained, no area": (
        [(0, 0, 4, 4), (1, 1, 2, 2), (7, 7, 7, 9)], [(0, 0), (0, 4), (4, 0), (4, 4)], [],
    ),
    "empty": ([], [], []),
}


@pytest.mark.parametrize("limit", [64, 2])
@pytest.mark.parametrize("case", UNIONS)
def test_union(rects, monkeypatch, case, limit):
    monkeypatch.setattr(union_module, "_TILE_LIMIT", limit)
    given, corners, straight = UNIONS[case]
    want = {(*p, "corner") for p in corners} | {(*p, "collinear") for p in straight}
    got = rows(qd.rect_union(rects(given)))
    assert len(got) == len(want) and set(got) == want
    assert set(rows(qd.rect_union(rects(given), corners_only=True))) == {w for w in want if w[2] == "corner"}


def test_empty_sides(rects, points):
    empty_points, empty_rects = points([]), rects([])
    q = rects([QUERY])
    none = q.where("id < 0")
    some = points([(1, 1.0, 1.0)])
    assert rows(qd.spatial_join(some, none)) == []
    assert rows(qd.spatial_count(some, none)) == []
    assert rows(qd.spatial_join(some.where("id < 0"), q)) == []
    assert rows(qd.spatial_join(q.where("id < 0"), q)) == []
    assert rows(qd.spatial_count(some.where("id < 0"), q, how="left")) == [(1, 0)]
    assert empty_points.count() == empty_rects.count() == 0
