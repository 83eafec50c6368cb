"""Outline vertices of the union of many rectangles."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.predicates import box_of
from ..functions.shapes import checked, coordinate_columns
from ..plans import grid
from ..plans.materialize import checkpointed
from .spatial_join import as_boxes

_TILE_LIMIT = 64  # boxes in one tile before it is split
_SHARES = (0.25, 0.5, 0.75)  # a crowded tile is cut at these quantiles of its sides, on both axes
# Joins on tiles are told to merge: estimates know only the boxes, not the tiles they are listed in,
# and Spark would send sides of any size to every executor.
_TILE = ("tx", "cy")
_BOX = ("xmin", "ymin", "xmax", "ymax")
_STRAIGHT = (3, 6, 9, 12)  # two neighbouring quadrants: the outline runs straight on


def _tile_size(ext: grid.Extents) -> tuple[int, int]:
    """Exponents of the tile sides.

    Near the size of most boxes, coarser while tiles would be nearly empty or
    large boxes would have to be listed in too many tiles along their border.
    """

    def typical(axis: int, span: float) -> int:
        sizes = sorted((s[axis], s[2]) for s in ext.sizes)
        seen, need = 0, 0.75 * ext.rows
        for e, n in sizes:
            seen += n
            if seen >= need:
                break
        return max(e, math.ceil(math.log2(span)) - 40)

    ex, ey = typical(0, ext.xmax - ext.xmin), typical(1, ext.ymax - ext.ymin)
    tiles = max(1.0, (ext.xmax - ext.xmin) * 2.0**-ex) * max(1.0, (ext.ymax - ext.ymin) * 2.0**-ey)
    empty = max(0, round(math.log2(8 * tiles / ext.rows) / 2))
    ex, ey = ex + min(empty, 20), ey + min(empty, 20)

    def listed(up: int) -> float:
        return sum(
            n * 2 * (2.0 ** max(0, bx - ex - up) + 2.0 ** max(0, by - ey - up) + 2)
            for bx, by, n in ext.sizes
        )

    def crowd(up: int) -> float:
        """Boxes whose border passes a tile, were they spread evenly."""
        w, h = 2.0 ** (ex + up), 2.0 ** (ey + up)
        area = max(w, ext.xmax - ext.xmin) * max(h, ext.ymax - ext.ymin)
        return sum(
            n * ((2.0**bx + w) * (2.0**by + h) - max(0.0, 2.0**bx - w) * max(0.0, 2.0**by - h)) / area
            for bx, by, n in ext.sizes
        )

    up = 0
    while listed(up) > 16 * ext.rows and up < 60:
        up += 1
    while crowd(up) > _TILE_LIMIT and listed(up - 1) <= 64 * ext.rows:
        up -= 1
    return ex + up, ey + up


def _cell(name: str, origin: float, exponent: int) -> Column:
    return F.floor((F.col(name) - origin) * F.lit(2.0**-exponent))


def _cut(lo: Column, tile: Column, hi: Column, first: str, last: str) -> tuple[Column, Column]:
    """Box side within a tile; an end outside the tile becomes infinite.

    Boxes that look alike inside a tile become equal rows there.
    """
    return (
        F.when(lo < tile, -math.inf).otherwise(F.col(first)),
        F.when(hi > tile, math.inf).otherwise(F.col(last)),
    )


class _Tiling:
    def __init__(self, ext: grid.Extents) -> None:
        self.x0, self.y0 = ext.xmin, ext.ymin
        self.ex, self.ey = _tile_size(ext)

    def ranges(self, boxes: DataFrame) -> DataFrame:
        return boxes.withColumns(
            {
                "cx0": _cell("xmin", self.x0, self.ex), "cx1": _cell("xmax", self.x0, self.ex),
                "cy0": _cell("ymin", self.y0, self.ey), "cy1": _cell("ymax", self.y0, self.ey),
            }
        )

    @staticmethod
    def listed(ranged: DataFrame) -> DataFrame:
        """Boxes in the tiles that their border runs through, cut to the tile.

        Equal rows are left in.
        """
        side = (F.col("cx") == F.col("cx0")) | (F.col("cx") == F.col("cx1"))
        along = F.when(side, F.sequence("cy0", "cy1")).otherwise(
            F.array_distinct(F.array("cy0", "cy1"))
        )
        rows = ranged.withColumn("cx", F.explode(F.sequence("cx0", "cx1"))).withColumn(
            "cy", F.explode(along)
        )
        x1, x2 = _cut(F.col("cx0"), F.col("cx"), F.col("cx1"), "xmin", "xmax")
        y1, y2 = _cut(F.col("cy0"), F.col("cy"), F.col("cy1"), "ymin", "ymax")
        return rows.select(
            F.col("cx").alias("tx"), "cy",
            x1.alias("xmin"), y1.alias("ymin"), x2.alias("xmax"), y2.alias("ymax"),
        )


def _without_covered(rows: DataFrame, ranged: DataFrame, big: bool) -> DataFrame:
    """Drop tiles that lie inside one box: the outline does not pass there.

    Tiles are points and the inner tiles of a box are a box, so this is the
    spatial join again, on tile numbers.
    """
    if not big:
        return rows
    inner = ranged.where("cx1 - cx0 > 1 AND cy1 - cy0 > 1").select(
        *(
            F.expr(e).cast("double").alias(n)
            for e, n in zip(("cx0 + 1", "cy0 + 1", "cx1 - 1", "cy1 - 1"), _BOX)
        )
    )
    ext = grid.measure(inner)
    if ext.rows == 0:
        return rows
    tiles = rows.select(*_TILE).distinct()
    number = {"x": F.col("tx").cast("double"), "y": F.col("cy").cast("double")}
    points = tiles.select(*(number[n[0]].alias(n) for n in _BOX), *_TILE)
    layout = grid.plan_layout(ext, None)
    side = "queries" if layout.query_cells <= grid._BROADCAST_ROWS else None
    q, t = box_of("q_"), box_of("t_")
    covered = (
        grid.meet(points, inner, layout, True, side)
        .where(t.xmin.between(q.xmin, q.xmax) & t.ymin.between(q.ymin, q.ymax))
        .select(*(F.col("t_" + c).alias(c) for c in _TILE))
        .distinct()
    )
    return rows.join(covered.hint("merge"), list(_TILE), "left_anti")


def _cuts(rows: DataFrame) -> DataFrame:
    """Crowded tiles with a number of their own and the values to cut them at.

    The values are quantiles of the distinct ends that lie inside the tile.  A tile with
    9 rows or more has two such ends on one axis at least, and the last quantile of two or
    more values is not the least of them: every child has fewer distinct ends than its tile,
    mostly a quarter, wherever they lie and however near to each other.  So the cutting ends.
    """
    crowded = rows.groupBy(*_TILE).count().where(F.col("count") > _TILE_LIMIT)
    ends = [F.struct(F.lit(c[0]).alias("axis"), F.col(c).alias("at")) for c in _BOX]
    inside = (
        rows.join(crowded.hint("merge"), list(_TILE), "left_semi")
        .select(*_TILE, F.explode(F.array(*ends)).alias("end"))
        .select(*_TILE, "end.axis", "end.at")
        .where(F.abs("at") < math.inf)
        .distinct()
    )

    def quantiles(axis: str) -> Column:
        own = F.when(F.col("axis") == axis, F.col("at"))
        found = F.percentile_approx(own, list(_SHARES))
        return F.coalesce(found, F.array().cast("array<double>")).alias("at_" + axis)

    cuts = (
        inside.groupBy(*_TILE)
        .agg(quantiles("x"), quantiles("y"), F.count_if(F.col("axis") == "x").alias("xs"), F.count("*").alias("all"))
        .where("xs > 1 OR all - xs > 1")
        .drop("xs", "all")
    )
    return checkpointed(cuts.withColumn("number", F.monotonically_increasing_id()))


def _split(rows: DataFrame, cuts: DataFrame, round_: int) -> DataFrame:
    """Move the boxes of crowded tiles to the tiles between their cuts.

    Ends outside the crowded tile are infinite and lie before and behind all cuts.
    Children inside one box are dropped.
    """
    ranged = rows.join(cuts.hint("merge"), list(_TILE))
    for axis in ("x", "y"):
        behind = "size(filter(at_{0}, c -> c <= {0}{1}))"
        ranged = ranged.withColumns(
            {axis + "0": F.expr(behind.format(axis, "min")), axis + "1": F.expr(behind.format(axis, "max"))}
        ).withColumn("n" + axis, F.explode(F.sequence(axis + "0", axis + "1")))
    x1, x2 = _cut(F.col("x0"), F.col("nx"), F.col("x1"), "xmin", "xmax")
    y1, y2 = _cut(F.col("y0"), F.col("ny"), F.col("y1"), "ymin", "ymax")
    # tiles of the plane have numbers from 0, children of round r numbers below 0
    side = len(_SHARES) + 1
    child = -(F.lit(round_) * side * side + F.col("nx") * side + F.col("ny") + 1)
    children = ranged.select(
        F.col("number").alias("tx"), child.cast("long").alias("cy"),
        x1.alias("xmin"), y1.alias("ymin"), x2.alias("xmax"), y2.alias("ymax"),
    ).dropDuplicates()
    covering = (
        (F.col("xmin") == -math.inf) & (F.col("xmax") == math.inf)
        & (F.col("ymin") == -math.inf) & (F.col("ymax") == math.inf)
    )
    covered = children.where(covering).select(*_TILE)
    return children.where(~covering).join(covered.hint("merge"), list(_TILE), "left_anti")


def _tiles(boxes: DataFrame, ext: grid.Extents) -> DataFrame:
    """Boxes by tile, no tile with more than ``_TILE_LIMIT`` (or 8) different rows."""
    tiling = _Tiling(ext)
    big = any(bx > tiling.ex and by > tiling.ey for bx, by, _ in ext.sizes)
    ranged = tiling.ranges(boxes)
    rows = checkpointed(_without_covered(tiling.listed(ranged), ranged, big).dropDuplicates())
    done: DataFrame | None = None
    for round_ in itertools.count():
        cuts = _cuts(rows)
        if cuts.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cool = rows.join(cuts.select(*_TILE).hint("merge"), list(_TILE), "left_anti")
        done = cool if done is None else done.unionByName(cool)
        rows = checkpointed(_split(rows, cuts, round_))


def _either(df: DataFrame, fixed: str, a: str, b: str, *keep: Column | str) -> DataFrame:
    """Two rows per box, one for each of the parallel sides ``a`` and ``b``."""
    return df.select(*_TILE, *keep, F.explode(F.array(a, b)).alias(fixed)).where(
        F.abs(fixed) < math.inf
    )


def rect_union(
    rects: DataFrame,
    columns: Sequence[str] | None = None,
    corners_only: bool = False,
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Rows (x, y, kind): every vertex of the outline, holes included, once.

    ``corner``     the outline changes direction there
    ``collinear``  a corner of an input rectangle on a straight part of the outline

    Rectangles without area are ignored.  The plane is cut into tiles; a tile
    knows every rectangle that touches a point it owns, so tiles are finished
    independently.  Crowded tiles are cut at quantiles of the sides inside them until
    none is left, tiles inside one rectangle dropped.
    ``on_bad='fail'`` refuses bad coordinates, ``observation`` counts them.
    """
    rects = checked(rects, coordinate_columns(rects, columns), on_bad, observation)
    boxes, points = as_boxes(rects, columns, [])
    if points:
        raise ValueError("rect_union needs rectangles")
    boxes = boxes.where("xmin < xmax AND ymin < ymax")
    ext = grid.measure(boxes)
    if ext.rows == 0:
        return boxes.select(
            F.col("xmin").alias("x"), F.col("ymin").alias("y"), F.lit("corner").alias("kind")
        )
    tiled = _tiles(boxes, ext).select(*_TILE, *_BOX).repartition(*_TILE)
    upright = _either(tiled, "x", "xmin", "xmax", F.col("ymin").alias("v1"), F.col("ymax").alias("v2"))
    flat = _either(tiled, "y", "ymin", "ymax", F.col("xmin").alias("h1"), F.col("xmax").alias("h2"))
    # the sides of one rectangle meet in its corners, those of two in crossings
    vertices = (
        upright.join(flat.hint("merge"), list(_TILE))
        .where("h1 <= x AND x <= h2 AND v1 <= y AND y <= v2")
        .select(*_TILE, "x", "y")
        .distinct()
    )
    x, y, b = F.col("x"), F.col("y"), box_of()
    right, left, above, below = x < b.xmax, x > b.xmin, y < b.ymax, y > b.ymin
    quadrants = [(right & above, 1), (left & above, 2), (left & below, 4), (right & below, 8)]
    bits = sum((F.when(c, v).otherwise(0) for c, v in quadrants), F.lit(0))
    masks = (
        vertices.join(tiled.hint("merge"), list(_TILE))
        .where(x.between(b.xmin, b.xmax) & y.between(b.ymin, b.ymax))
        .groupBy(*_TILE, "x", "y")
        .agg(F.bit_or(bits).alias("mask"))
        .where(~F.col("mask").isin(0, 15))
    )
    straight = F.col("mask").isin(*_STRAIGHT)
    if corners_only:
        masks = masks.where(~straight)
    return masks.select(
        "x", "y", F.when(straight, "collinear").otherwise("corner").alias("kind")
    )

