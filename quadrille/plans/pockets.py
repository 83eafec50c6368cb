"""Convex hull piece by piece, for hulls too large for one task.

The lower chain is cut into pockets, each between two points known to be on or
next to the chain; a pocket keeps only points that are not surely above its
chord.  Crowded pockets are cut again at several points far below chords.  The
upper chain is the lower chain of the mirrored points (``v = side * y``).

Cut points are chosen with doubles, so the chain is checked exactly where two
pockets join; pockets that do not join with a strict left turn are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kernels import _DET_ERROR, hull_ring, turn
from . import grid
from .materialize import checkpointed

_BROADCAST_ROWS = 200_000
_PIECES = 8  # parts of a crowded pocket, by quantiles of x
_ENDS = ("ax", "av", "bx", "bv")
_CHAIN = "side int, pocket long, ax double, av double, seq long, x double, v double, nx double, nv double"
_WIDER = 1e-14


def _below(ax: Column, av: Column, bx: Column, bv: Column) -> tuple[Column, Column]:
    """Determinant of chord and point (negative below), and its error bound."""
    left = (bx - ax) * (F.col("v") - av)
    right = (bv - av) * (F.col("x") - ax)
    return left - right, F.lit(_DET_ERROR) * (F.abs(left) + F.abs(right))


def _keep(df: DataFrame) -> DataFrame:
    det, error = _below(*(F.col(c) for c in _ENDS))
    return df.where(det <= error).withColumn("det", det)


def _mirrored(points: DataFrame) -> DataFrame:
    """Every point once per side, with the ends of its chain as first chord."""
    both = points.select(F.explode(F.array(F.lit(1), F.lit(-1))).alias("side"), "x", "y")
    both = both.select("side", "x", (F.col("side") * F.col("y")).alias("v"))
    ends = both.groupBy("side").agg(
        F.min(F.struct("x", "v")).alias("a"),
        F.min(F.struct((-F.col("x")).alias("x"), "v")).alias("b"),
    )
    ends = ends.select(
        "side", F.col("a.x").alias("ax"), F.col("a.v").alias("av"),
        (-F.col("b.x")).alias("bx"), F.col("b.v").alias("bv"),
    )
    first = both.join(F.broadcast(ends), "side")  # two rows
    return _keep(first.withColumn("pocket", F.lit(1).cast("long")))


def _lowest(hot: DataFrame, chords: int) -> DataFrame:
    """``side, pocket, cuts``: points of each pocket known to be on or next to the chain, by x.

    The lowest point below the chord is taken in each of ``chords - 1`` parts of about as
    many points; then the point farthest below each chord between neighbours of these.
    """
    key = ["side", "pocket"]
    part = F.size(F.filter("at", lambda a: a < F.col("x")))
    low = hot.groupBy(*key, part.alias("part")).agg(F.min(F.struct("det", "x", "v")).alias("s")).where("s.det < 0")
    low = low.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("s.x", "s.v"))).alias("stops"),
        F.min("s").alias("best"),
    )
    a, b = (F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}v").alias("v")) for e in "ab")
    line = hot.join(low, key).withColumn("line", F.concat(F.array(a), "stops", F.array(b)))
    below = []
    for i in range(chords):
        begin, end = F.get("line", F.lit(i)), F.get("line", F.lit(i + 1))
        det, _ = _below(begin["x"], begin["v"], end["x"], end["v"])
        below.append(F.min(F.when(det < 0, F.struct(det.alias("det"), "x", "v"))).alias(f"e{i}"))
    ends = [F.first(c).alias(c) for c in ("ax", "bx", "best")]
    point = [F.struct(F.col(f"{e}.x").alias("x"), F.col(f"{e}.v").alias("v")) for e in ("best", *(f"e{i}" for i in range(chords)))]
    found = line.groupBy(*key).agg(*below, *ends).select(*key, "ax", "bx", F.sort_array(F.array(*point)).alias("p"))
    inside = F.filter("p", lambda q: (q["x"] > F.col("ax")) & (q["x"] < F.col("bx")))
    found = found.select(*key, inside.alias("p"))
    lowest_at_x = F.filter("p", lambda q, i: (i == 0) | (q["x"] != F.get("p", i - 1)["x"]))
    return found.select(*key, lowest_at_x.alias("cuts"))


def _cut(points: DataFrame, one_task: int) -> DataFrame:
    """Cut pockets until none holds more than ``one_task`` points.

    A round cuts a pocket in up to ``_PIECES + 2`` places, chosen by quantiles of x, so the
    number of rounds grows with the logarithm of the points.
    """
    key = ["side", "pocket"]
    left = checkpointed(_mirrored(points))
    done: DataFrame | None = None
    free = 2  # the first number that no pocket has had
    shares = F.array(*(F.lit(i / _PIECES) for i in range(1, _PIECES)))
    while True:
        hot = checkpointed(
            left.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("n"), F.min("det").alias("lowest"), F.percentile_approx("x", shares, 1000).alias("at"))
            .where((F.col("n") > one_task) & (F.col("lowest") < 0))
            # one row per crowded pocket: their number is bounded by survivors / one_task
            .select(*key, "at", (F.row_number().over(Window.orderBy(*key)) - 1).alias("place"))
        )
        found = hot.count()
        if found == 0:
            return left if done is None else done.unionByName(left)
        small = F.broadcast if found <= _BROADCAST_ROWS else (lambda df: df)
        cool = left.join(small(hot.select(*key)), key, "left_anti")
        done = cool if done is None else done.unionByName(cool)
        inside = left.join(small(hot), key)
        cuts = checkpointed(_lowest(inside, _PIECES + 1))
        a, b = (F.struct(F.col(f"{e}x").alias("x"), F.col(f"{e}v").alias("v")) for e in "ab")
        step = _PIECES + 4
        rows = inside.drop("at").join(small(cuts), key).select(
            "side", "x", "v", (free + F.col("place") * step).cast("long").alias("first"),
            F.concat(F.array(a), "cuts", F.array(b)).alias("line"),
            F.size(F.filter("cuts", lambda c: c["x"] < F.col("x"))).alias("j"),
        )
        begin, end = F.get("line", F.col("j")), F.get("line", F.col("j") + 1)
        left = checkpointed(
            _keep(
                rows.select(
                    "side", "x", "v", (F.col("first") + F.col("j")).alias("pocket"),
                    begin["x"].alias("ax"), begin["v"].alias("av"), end["x"].alias("bx"), end["v"].alias("bv"),
                )
            )
        )
        free += found * step


def _chain_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """Exact lower chain of one pocket, one row per edge (its left end)."""
    first, last = pdf.loc[pdf.ax.idxmin()], pdf.loc[pdf.bx.idxmax()]
    x = np.concatenate([pdf.x.to_numpy(), pdf.ax.to_numpy(), pdf.bx.to_numpy()])
    v = np.concatenate([pdf.v.to_numpy(), pdf.av.to_numpy(), pdf.bv.to_numpy()])
    x, v = hull_ring(x, v)
    end = int(np.nonzero((x == last.bx) & (v == last.bv))[0][0])
    x, v = x[: end + 1], v[: end + 1]
    n = max(1, len(x) - 1)
    return pd.DataFrame(
        {
            "side": pdf.side.iloc[0], "pocket": pdf.pocket.iloc[0], "ax": first.ax, "av": first.av,
            "seq": np.arange(n), "x": x[:n], "v": v[:n], "nx": x[-n:], "nv": v[-n:],
        }
    )


def _wrong_turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        cols = (pdf.px, pdf.pv, pdf.x, pdf.v, pdf.nx, pdf.nv)
        good = [turn(*p) > 0 for p in zip(*(c.tolist() for c in cols))]
        yield pdf.assign(good=np.array(good, dtype=bool))[["side", "ax", "good"]]


def _join_up(chain: DataFrame) -> DataFrame | None:
    """New pocket numbers where pockets do not join properly, or ``None``."""
    key = ["side", "pocket"]
    last = chain.groupBy(*key).agg(F.max_by(F.struct("x", "v", "nx", "nv"), "seq").alias("e"))
    last = last.select("side", F.col("e.x").alias("px"), F.col("e.v").alias("pv"),
                       F.col("e.nx").alias("x"), F.col("e.nv").alias("v"))
    first = chain.where("seq = 0").select("side", "ax", "x", "v", "nx", "nv")
    joints = last.join(first, ["side", "x", "v"]).where("px < x")
    turns = checkpointed(
        joints.select("side", "ax", "px", "pv", "x", "v", "nx", "nv").mapInPandas(
            _wrong_turns, "side int, ax double, good boolean"
        )
    )
    if turns.where("NOT good").limit(1).count() == 0:
        return None
    # one row per pocket: its number is bounded by survivors / one_task
    order = Window.partitionBy("side").orderBy("ax")
    return (
        chain.where("seq = 0").select("side", "pocket", "ax")
        .join(turns, ["side", "ax"], "left")
        .withColumn("merged", F.sum(F.when(~F.col("good"), 0).otherwise(1)).over(order))
        .select("side", "pocket", "merged")
    )


def hull_edges(points: DataFrame, one_task: int) -> DataFrame:
    """Edges of both chains, left to right: side, (x, v) -> (nx, nv), v = side * y."""
    pockets = _cut(points, one_task).select("side", "pocket", "x", "v", *_ENDS)
    chain = checkpointed(pockets.groupBy("side", "pocket").applyInPandas(_chain_of, _CHAIN))
    while True:
        merged = _join_up(chain)
        if merged is None:
            return chain
        again = chain.join(merged, ["side", "pocket"]).select(
            "side", F.col("merged").alias("pocket"), "x", "v",
            F.col("x").alias("ax"), F.col("v").alias("av"),
            F.col("nx").alias("bx"), F.col("nv").alias("bv"),
        )
        chain = checkpointed(again.groupBy("side", "pocket").applyInPandas(_chain_of, _CHAIN))


def hull_by_pockets(points: DataFrame, one_task: int) -> DataFrame:
    """Hull vertices (x, y), ordered."""
    edges = hull_edges(points, one_task)
    ends = F.array(
        F.struct(F.col("x"), F.col("v")), F.struct(F.col("nx").alias("x"), F.col("nv").alias("v"))
    )
    vertex = edges.select("side", F.explode(ends).alias("p"))
    return (
        vertex.select(F.col("p.x").alias("x"), (F.col("side") * F.col("p.v")).alias("y"))
        .distinct()
        .orderBy("x", "y")
    )


def farthest_by_edges(points: DataFrame, one_task: int) -> DataFrame:
    """Farthest pair of a large hull.

    A farthest pair consists of an end of some edge and the vertex of the other
    chain where a line of the same slope touches.  Slopes are matched with the
    spatial join in one dimension: edges are points, vertices are intervals
    between the slopes of their two edges.
    """
    flat = points.agg(F.min(F.struct("x", "y")).alias("a"), F.max(F.struct("x", "y")).alias("b"))
    if flat.where("a.x = b.x").limit(1).count():
        return flat.selectExpr("a.x AS x1", "a.y AS y1", "b.x AS x2", "b.y AS y2", "b.y - a.y AS distance")
    edges = hull_edges(points, one_task).withColumn("y", F.col("side") * F.col("v"))
    edges = edges.withColumn("ny", F.col("side") * F.col("nv"))
    size = edges.agg(
        (F.max("nx") - F.min("x")).alias("w"),
        (F.greatest(F.max("y"), F.max("ny")) - F.least(F.min("y"), F.min("ny"))).alias("h"),
    ).first()
    slope = F.atan2((F.col("ny") - F.col("y")) / (size.h or 1.0), (F.col("nx") - F.col("x")) / (size.w or 1.0))
    edges = checkpointed(edges.where("x < nx").select("side", "x", "y", "nx", "ny", slope.alias("s")))
    into = edges.select("side", F.col("nx").alias("x"), F.col("ny").alias("y"), F.col("s").alias("s1"))
    out = edges.select("side", "x", "y", F.col("s").alias("s2"))
    vertices = into.join(out, ["side", "x", "y"], "full")
    steepest = F.lit(1.6)  # beyond every angle: the chain ends there
    low = F.when(F.col("side") == 1, F.coalesce("s1", -steepest)).otherwise(F.coalesce("s2", -steepest))
    high = F.when(F.col("side") == 1, F.coalesce("s2", steepest)).otherwise(F.coalesce("s1", steepest))
    zero = F.lit(0.0)
    facing = vertices.select(
        (low - _WIDER).alias("xmin"), zero.alias("ymin"), (high + _WIDER).alias("xmax"),
        zero.alias("ymax"), "side", "x", "y",
    )
    slopes = edges.select(
        F.col("s").alias("xmin"), zero.alias("ymin"), F.col("s").alias("xmax"), zero.alias("ymax"),
        "side", "x", "y", "nx", "ny",
    )
    layout = grid.plan_layout(grid.measure(facing), None)
    side = "queries" if layout.query_cells <= grid._BROADCAST_ROWS else None
    met = grid.meet(slopes, facing, layout, True, side).where(
        (F.col("t_side") != F.col("q_side")) & F.col("t_xmin").between(F.col("q_xmin"), F.col("q_xmax"))
    )
    ends = F.array(
        F.struct(F.col("t_x").alias("x"), F.col("t_y").alias("y")),
        F.struct(F.col("t_nx").alias("x"), F.col("t_ny").alias("y")),
    )
    corner = F.struct(F.col("q_x").alias("x"), F.col("q_y").alias("y"))
    pairs = met.select(F.explode(ends).alias("e"), corner.alias("c"))
    pairs = pairs.select(F.least("e", "c").alias("a"), F.greatest("e", "c").alias("b"))
    dx, dy = F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")
    return (
        pairs.select(
            F.col("a.x").alias("x1"), F.col("a.y").alias("y1"),
            F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), (dx * dx + dy * dy).alias("d2"),
        )
        .orderBy(F.desc("d2"), "x1", "y1", "x2", "y2")
        .limit(1)
        .select("x1", "y1", "x2", "y2", F.sqrt("d2").alias("distance"))
    )
