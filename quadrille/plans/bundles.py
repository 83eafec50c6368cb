"""Bundles of neighbouring queries: lists are made where their targets come together.

The pairs of a join grow with the product of its tables, so the pairs of a query are not
moved to make its list.  Query ids are sorted into bundles of some hundred that lie close
together, a target goes once to every bundle whose box it meets, and one task compares
the two and gathers all lists of the bundle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import Box, box_of
from . import grid
from .materialize import checkpointed

# Query ids of a bundle: Spark gathers lists in memory for up to 128 keys of a task, more are sorted pair by pair.
_IDS = 100
# Fewer query rows are not bundled: their pairs grow with the targets alone.
_MIN_ROWS = 5_000
# Bundles for each core at least.
_PER_CORE = 4
# Comparisons for a pair, and targets moved for a pair, up to which bundles pay, for targets spread evenly.
_COMPARED = 32.0
_MOVED = 0.25
_MAX_STRIPS = 4096
_MAX_PARTS = 20_000


@dataclass
class Bundles:
    """``queries``: valid query rows with ``bundle``, ``boxes``: the box of each bundle, numbered from 0."""

    queries: DataFrame
    boxes: DataFrame
    count: int

    @property
    def parts(self) -> int:
        return min(self.count, _MAX_PARTS)


def _strips(ext: grid.Extents, bundles: float) -> tuple[int, float]:
    """Number and width of strips that make bundles look like the queries."""
    spans = ext.xmax - ext.xmin, ext.ymax - ext.ymin
    sides = [sum(n * 2.0 ** s[axis] for *s, n in ext.sizes if s[axis] is not None) / ext.rows for axis in (0, 1)]
    across, along = (max(1.0, span / side) if side else 1.0 for span, side in zip(spans, sides, strict=True))
    strips = max(1, round(min(_MAX_STRIPS, (bundles * across / along) ** 0.5)))
    return strips, spans[0] / strips


def in_bundles(queries: DataFrame, ext: grid.Extents) -> Bundles | None:
    """Bundle the query boxes by ``qid``; None where moving pairs costs less.

    All rows of an id share a bundle.  Ids are cut into strips by x and into runs by y.
    """
    if ext.rows < _MIN_ROWS or not 0 < ext.area < float("inf"):
        return None
    cores = queries.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(_IDS, ext.rows // (_PER_CORE * cores)))
    strips, width = _strips(ext, ext.rows / size)
    x0 = grid._num(ext.xmin)
    homes = (
        queries.groupBy(F.col("qid").alias("home"))
        .agg(F.expr("min(xmin / 2 + xmax / 2)").alias("x"), F.expr("min(ymin / 2 + ymax / 2)").alias("y"))
        .withColumn("strip", F.expr(f"int(least(floor((x - {x0}) / {grid._num(width)}), {strips - 1}L))"))
        .repartitionByRange("strip", "y").sortWithinPartitions("strip", "y", "home")
        .select("home", "strip", F.expr(f"monotonically_increasing_id() div {size}").alias("run"))
    )
    placed = checkpointed(queries.join(homes.hint("merge"), F.col("qid").eqNullSafe(F.col("home"))).drop("home"))
    # a row for some hundred queries: numbered in one task
    boxes = checkpointed(
        placed.groupBy("strip", "run")
        .agg(*(F.min(c).alias(c) for c in Box._fields[:2]), *(F.max(c).alias(c) for c in Box._fields[2:]),
             F.count(F.lit(1)).alias("n"))
        .withColumn("bundle", F.row_number().over(Window.orderBy("strip", "run")) - 1)
    )
    area = "(xmax - xmin) * (ymax - ymin)"
    count, moved, compared = boxes.agg(F.expr("count(1)"), F.expr(f"sum({area})"), F.expr(f"sum(n * {area})")).first()
    if not (moved <= _MOVED * ext.area and compared <= _COMPARED * ext.area):
        return None
    names = boxes.select("strip", "run", "bundle")
    names = F.broadcast(names) if count <= grid._BROADCAST_ROWS else names.hint("merge")
    return Bundles(placed.join(names, ["strip", "run"]).drop("strip", "run"), boxes.drop("strip", "run", "n"), count)


def pairs_of(
    bundles: Bundles, routed: DataFrame, points: bool, predicate: Callable[[Box, Box], Column], left: bool
) -> DataFrame:
    """(bundle, qid, tid) in the tasks of their bundles.

    ``routed`` are the targets, prefixed ``t_``, with each ``bundle`` whose box they meet.
    ``left`` adds a null target for each query.
    """
    corners = [f"t_{c}" for c in (Box._fields[:2] if points else Box._fields)]
    t = routed.select("bundle", "t_tid", *corners)
    if left:
        t = t.withColumn("nobody", F.lit(False)).unionByName(
            bundles.boxes.select("bundle", F.lit(True).alias("nobody")), allowMissingColumns=True
        )
    t = t.repartitionById(bundles.parts, F.col("bundle"))
    if points:
        t = t.withColumns({"t_xmax": F.col("t_xmin"), "t_ymax": F.col("t_ymin")})
    q = bundles.queries.select("bundle", "qid", *(F.col(c).alias(f"q_{c}") for c in Box._fields))
    q = q.repartitionById(bundles.parts, F.col("bundle"))
    meets = predicate(box_of("q_"), box_of("t_"))
    if left:
        meets = F.col("nobody") | meets
    return t.join(q.hint("shuffle_hash"), "bundle").where(meets).select("bundle", "qid", F.col("t_tid").alias("tid"))
