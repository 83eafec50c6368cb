"""The two points with the least distance, exactly."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.kernels import better, closest_in
from ..functions.shapes import checked, points_only
from ..plans import grid
from ..plans.materialize import checkpointed

_ROWS_PER_STRIP = 500_000
# Tasks, not memory, bound the number of strips: a strip is streamed, so beyond this all grow alike.
_MAX_STRIPS = 100_000
_SWEEP = 1 << 18
_ROUND_OFF = 1 + 1e-9
_PAIR = "x1 double, y1 double, x2 double, y2 double, d2 double"
# kind 0: best pair of a strip; kind 1: point near an end of its strip
_STRIP = f"kind int, strip int, {_PAIR}, gap double"


def _fold_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points of one task that may still decide the answer, before they are shuffled.

    Copies have distance 0, and of all copied points the smallest is the answer.  Once a
    task has met a point twice within a chunk, larger points are of no use and its own further
    copies are dropped: a point leaves the task a few times at most, however often it occurs.
    """
    least: tuple[float, float] | None = None  # the smallest point met twice, already handed on

    for batch in _gathered(batches):
        x, y = batch[:, 0], batch[:, 1]
        if least is not None:
            below = (x < least[0]) | ((x == least[0]) & (y < least[1]))
            x, y = x[below], y[below]
        if len(x) == 0:
            continue
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        twice = np.nonzero((x[1:] == x[:-1]) & (y[1:] == y[:-1]))[0]
        if len(twice):
            end = twice[0] + 2
            least, x, y = (x[end - 1], y[end - 1]), x[:end], y[:end]
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows (x, y) in chunks of some ``_SWEEP`` rows."""
    waiting: list[np.ndarray] = []
    for batch in batches:
        waiting.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]]) + 0.0)
        if sum(map(len, waiting)) >= _SWEEP:
            yield np.concatenate(waiting)
            waiting = []
    if waiting:
        yield np.concatenate(waiting)


def _strip_sweep(axis: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sweep over one strip, whose rows arrive in the order of ``axis``.

    Keeps a chunk and the points behind it that may still find a neighbour, so a
    strip of any length needs little memory.  Emits the best pair of the strip
    and the points that lie near its ends; only those can have a nearer
    neighbour in another strip.
    """

    def rows(kind: int, strip: int, *values: np.ndarray) -> pa.RecordBatch:
        n = len(values[0])
        arrays = [pa.array(np.full(n, kind, "int32")), pa.array(np.full(n, strip, "int32"))]
        names = ["kind", "strip", "x1", "y1", "x2", "y2", "d2", "gap"]
        return pa.RecordBatch.from_arrays([*arrays, *(pa.array(v) for v in values)], names)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip = TaskContext.get().partitionId()
        best: tuple | None = None
        kept = np.empty((0, 2))  # the last points of the sweep, within reach
        head: list[np.ndarray] = []  # points near the start of the strip
        first = None

        def reach() -> float:
            return math.inf if best is None else math.sqrt(best[0]) * _ROUND_OFF

        def advance(chunk: np.ndarray) -> None:
            nonlocal best, kept, first, head
            if first is None:
                first = chunk[0, axis]
            near = np.concatenate([kept, chunk])
            best = better(best, closest_in(near[:, 0], near[:, 1]))
            if best is not None and best[0] == 0.0:
                # equal points share a strip: only the next row can be another copy
                kept, head = near[-1:], []
                return
            kept = near[near[-1, axis] - near[:, axis] <= reach()]
            fresh = chunk[chunk[:, axis] - first <= reach()]
            head = [h[h[:, axis] - first <= reach()] for h in head] + [fresh]

        waiting: list[np.ndarray] = []
        for batch in batches:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            waiting.append(np.column_stack([x, y]))
            if sum(map(len, waiting)) >= max(_SWEEP, len(kept)):
                advance(np.concatenate(waiting))
                waiting = []
        if waiting:
            advance(np.concatenate(waiting))
        if first is None:
            return
        if best is not None:
            d2, *ends = best
            yield rows(0, strip, *(np.array([v]) for v in (*ends, d2, 0.0)))
            if d2 == 0.0:
                return
        start = np.concatenate(head)
        last = kept[-1, axis]
        # a point near both ends is emitted once, with its smaller gap
        tail = kept[(kept[:, axis] - first) > reach()]
        for pts in (start, tail):
            if len(pts):
                gap = np.minimum(pts[:, axis] - first, last - pts[:, axis])
                none = np.zeros(len(pts))
                yield rows(1, strip, pts[:, 0], pts[:, 1], none, none, none, gap)

    return sweep


def _search_strips(points: DataFrame, axis: int, strips: int) -> DataFrame:
    order = ["x", "y"] if axis == 0 else ["y", "x"]
    cut = points.repartitionByRange(strips, *order).sortWithinPartitions(*order)
    return checkpointed(cut.mapInArrow(_strip_sweep(axis), _STRIP))


def _across_strips(border: DataFrame, radius: float) -> DataFrame:
    """Pairs of border points of different strips within ``radius``."""
    reach = radius * _ROUND_OFF
    point = border.select(
        F.col("x").alias("xmin"), F.col("y").alias("ymin"),
        F.col("x").alias("xmax"), F.col("y").alias("ymax"), "strip",
    )
    around = border.select(
        (F.col("x") - reach).alias("xmin"), (F.col("y") - reach).alias("ymin"),
        (F.col("x") + reach).alias("xmax"), (F.col("y") + reach).alias("ymax"),
        "x", "y", "strip",
    )
    extents = grid.measure(around)
    layout = grid.plan_layout(extents, None)
    side = "queries" if layout.query_cells <= grid._BROADCAST_ROWS else None
    pair = grid.meet(point, around, layout, True, side).where(F.col("q_strip") < F.col("t_strip"))
    a = F.struct(F.col("q_x").alias("x"), F.col("q_y").alias("y"))
    b = F.struct(F.col("t_xmin").alias("x"), F.col("t_ymin").alias("y"))
    pair = pair.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    dx, dy = F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")
    return pair.select(
        F.col("a.x").alias("x1"), F.col("a.y").alias("y1"),
        F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), (dx * dx + dy * dy).alias("d2"),
    )


def _as_result(pairs: DataFrame) -> DataFrame:
    return (
        pairs.orderBy("d2", "x1", "y1", "x2", "y2")
        .limit(1)
        .select("x1", "y1", "x2", "y2", F.sqrt("d2").alias("distance"))
    )


def _copies(points: DataFrame) -> DataFrame:
    """Points that occur more than once, as pairs of distance 0."""
    twice = points.groupBy("x", "y").count().where("count > 1")
    return twice.select(
        F.col("x").alias("x1"), F.col("y").alias("y1"),
        F.col("x").alias("x2"), F.col("y").alias("y2"), F.lit(0.0).alias("d2"),
    )


def closest_pair(
    points: DataFrame,
    x: str = "x",
    y: str = "y",
    strips: int | None = None,
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """One row (x1, y1, x2, y2, distance), smaller point first; none below 2 points.

    Copies of a point are two points at distance 0.  Ties go to the smallest
    (x1, y1, x2, y2).  Every task folds its copies, the points are range-partitioned once into strips, each
    strip is swept, and points near the strip ends are matched across strips
    with an equi-join on cells of the size of the best distance so far.
    ``on_bad='fail'`` refuses bad coordinates, ``observation`` counts them.
    """
    pts = points_only(checked(points, (x, y), on_bad, observation), x, y)
    size = pts.agg(
        F.count(F.lit(1)).alias("n"),
        (F.max("x") - F.min("x")).alias("span_x"),
        (F.max("y") - F.min("y")).alias("span_y"),
    ).first()
    n = size.n
    if n < 2:
        return _as_result(_copies(pts))
    axes = (0, 1) if size.span_x >= size.span_y else (1, 0)
    found, border, radius = None, pts.mapInArrow(_fold_copies, "x double, y double"), None
    for axis in axes:
        count = strips or min(_MAX_STRIPS, math.ceil(n / _ROWS_PER_STRIP))
        result = _search_strips(border.select("x", "y"), axis, count)
        best = result.where("kind = 0").select("x1", "y1", "x2", "y2", "d2")
        found = best if found is None else found.union(best)
        d2 = found.agg(F.min("d2")).first()[0]
        if count == 1:
            return _as_result(found)
        radius = math.hypot(size.span_x, size.span_y) if d2 is None else math.sqrt(d2)
        border = result.where((F.col("kind") == 1) & (F.col("gap") <= radius * _ROUND_OFF)).select(
            F.col("x1").alias("x"), F.col("y1").alias("y"), "strip"
        )
        n = border.count()
        if n <= _ROWS_PER_STRIP:
            break
    if n == 0:
        return _as_result(found)
    return _as_result(found.union(_across_strips(border, radius)))
