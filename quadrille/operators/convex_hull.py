"""Strict convex hull vertices of a point set."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation

from ..functions.kernels import hull_ring
from ..functions.shapes import checked, points_only
from ..plans.materialize import checkpointed
from ..plans.pockets import hull_by_pockets

_POINT = "x double, y double"
_CHUNK = 1 << 16
# Points that one task may finish alone (16 bytes each).
_ONE_TASK = 500_000


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(
        zero_copy_only=False
    )


def local_hull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hull of one task's points; keeps only the running hull and one chunk."""
    xs, ys, held = [], [], 0
    for batch in batches:
        x, y = _columns(batch)
        xs.append(x)
        ys.append(y)
        held += len(x)
        if held >= _CHUNK and held >= 2 * len(xs[0]):
            x, y = hull_ring(np.concatenate(xs), np.concatenate(ys))
            xs, ys, held = [x], [y], len(x)
    if held:
        x, y = hull_ring(np.concatenate(xs), np.concatenate(ys))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])


def _sorted_hull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in local_hull(batches):
        x, y = _columns(batch)
        order = np.lexsort((y, x))
        yield pa.RecordBatch.from_arrays([pa.array(x[order]), pa.array(y[order])], ["x", "y"])


def hull_survivors(points: DataFrame, one_task: int) -> tuple[DataFrame, int]:
    """Points that can still be vertices, computed once, and their number.

    Every task reduces its own points without a shuffle; while more than
    ``one_task`` survive they are regrouped and reduced again as long as that
    removes a fair part of them.
    """
    left = checkpointed(points.mapInArrow(local_hull, _POINT))
    count = left.count()
    while count > one_task:
        tasks = math.ceil(2 * count / one_task)
        smaller = checkpointed(left.repartition(tasks, "x", "y").mapInArrow(local_hull, _POINT))
        before, left, count = count, smaller, smaller.count()
        if count > 0.7 * before:
            break
    return left, count


def convex_hull(
    points: DataFrame,
    x: str = "x",
    y: str = "y",
    one_task: int = _ONE_TASK,
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Hull vertices (x, y), ordered by x then y.

    Points on an edge are no vertices.  Points on one line give its two ends,
    one distinct point gives itself, no point gives no row.  If more than
    ``one_task`` vertices are in play the hull is finished piecewise.
    ``on_bad='fail'`` refuses bad coordinates, ``observation`` counts them.
    """
    left, count = hull_survivors(points_only(checked(points, (x, y), on_bad, observation), x, y), one_task)
    if count > one_task:
        return hull_by_pockets(left, one_task)
    return left.repartition(1).mapInArrow(_sorted_hull, _POINT)
