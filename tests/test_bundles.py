"""Lists made in bundles of neighbouring queries are those of moved pairs."""

import math
import random

import pytest
import quadrille as qd
from quadrille.functions import predicates as P
from quadrille.plans import bundles

BOX = "x1 double, y1 double, x2 double, y2 double"


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(bundles, "_MIN_ROWS", 1)
    monkeypatch.setattr(bundles, "_IDS", 7)
    monkeypatch.setattr(bundles, "_COMPARED", math.inf)
    monkeypatch.setattr(bundles, "_MOVED", math.inf)


def boxes(spark, rng, n, kind, ids, wide):
    rows = []
    for i in ids:
        x, y = rng.randrange(60), rng.randrange(60)
        rows.append((i, float(x), float(y), float(x + rng.randrange(wide)), float(y + rng.randrange(wide))))
    return spark.createDataFrame(rows[:n], f"id {kind}, {BOX}")


def tables(spark, points):
    rng = random.Random(5)
    # ids repeat and are null on both sides, one query meets nothing, one has no coordinates
    q = boxes(spark, rng, 90, "string", [None if i % 30 == 7 else f"q{i % 80}" for i in range(90)], 14)
    q = q.union(spark.createDataFrame([("far", 900.0, 900.0, 901.0, 901.0), ("bad", None, 0.0, 1.0, 1.0)], q.schema))
    t = boxes(spark, rng, 400, "long", [None if i % 50 == 3 else i % 390 for i in range(400)], 1 if points else 9)
    return (t.selectExpr("id", "x1 AS x", "y1 AS y") if points else t), q


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def both(monkeypatch, make):
    got = found(make())
    monkeypatch.setattr(bundles, "_MIN_ROWS", 1 << 60)
    want = found(make())
    monkeypatch.setattr(bundles, "_MIN_ROWS", 1)
    return got, want


def moved_after_join(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return "Exchange" in text[: text.index("Join")]


@pytest.mark.parametrize("points, strategy", [(True, "auto"), (False, "auto"), (True, "shuffle")])
def test_lists_are_the_same(spark, monkeypatch, small, points, strategy):
    t, q = tables(spark, points)
    for options in (
        {"output": "lists", "how": "left"}, {"output": "parts", "part_size": 4},
        {"output": "lists", "predicate": lambda a, b: P.intersects(a, b) & P.contains(a, b)},
    ):
        got, want = both(monkeypatch, lambda o=options: qd.spatial_join(t, q, strategy=strategy, **o))
        assert got == want and len(got) > 20


def test_parts_of_a_bundle_may_share_a_task(spark, monkeypatch, small):
    t, q = tables(spark, True)
    monkeypatch.setattr(bundles, "_MAX_PARTS", 2)
    got, want = both(monkeypatch, lambda: qd.spatial_join(t, q, output="lists", how="left"))
    assert got == want


def test_pairs_are_not_moved(spark, small):
    for points in (True, False):
        t, q = tables(spark, points)
        for how, output in (("inner", "parts"), ("inner", "lists")):
            assert not moved_after_join(qd.spatial_join(t, q, how=how, output=output))
    t, q = tables(spark, True)
    text = qd.spatial_join(t, q, how="left", output="lists")._jdf.queryExecution().executedPlan().toString()
    # the targets, their bundles and the two sides of the ids without coordinates
    assert "ShuffledHashJoin" in text and "collect_list" not in text[text.index("ShuffledHashJoin") :]


def test_many_queries_are_bundled(spark):
    """5,000 overlapping queries are bundled without any setting; far ones are not."""
    q = spark.range(5000).selectExpr("id", *(f"double({v}) AS {n}" for n, v in (
        ("x1", "id % 71"), ("y1", "id % 73"), ("x2", "id % 71 + 40"), ("y2", "id % 73 + 40"))))
    t = spark.range(300).selectExpr("id", "double(id * 7 % 111) AS x", "double(id * 11 % 113) AS y")
    lists = qd.spatial_join(t, q, output="parts")
    assert not moved_after_join(lists)
    want = {}
    for r in qd.spatial_join(t, q).collect():
        want.setdefault(r.qid, []).append(r.tid)
    assert {r.qid: r.tids for r in lists.collect()} == {k: sorted(v) for k, v in want.items()}
    far = q.selectExpr("id", "x1 * 1000 AS x1", "y1 * 1000 AS y1", "x1 * 1000 + 1 AS x2", "y1 * 1000 + 1 AS y2")
    assert moved_after_join(qd.spatial_join(t, far, output="parts"))


def test_one_id_for_all_queries_moves_pairs(spark, monkeypatch, small):
    monkeypatch.undo()
    monkeypatch.setattr(bundles, "_MIN_ROWS", 1)
    t, q = tables(spark, True)
    lists = qd.spatial_join(t, q.selectExpr("1 AS id", "x1", "y1", "x2", "y2"), output="lists")
    assert moved_after_join(lists) and lists.count() == 1
