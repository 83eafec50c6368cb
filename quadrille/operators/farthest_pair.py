"""The two points with the greatest distance."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.kernels import farthest_of_ring
from ..functions.shapes import checked, points_only
from ..plans.pockets import farthest_by_edges
from .convex_hull import _ONE_TASK, _columns, hull_survivors, local_hull

_PAIR = "x1 double, y1 double, x2 double, y2 double, distance double"


def _farthest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in local_hull(batches):
        best = farthest_of_ring(*_columns(batch))
        if best is not None:
            d2, *ends = best
            row = [*ends, d2**0.5]
            names = ["x1", "y1", "x2", "y2", "distance"]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)


def farthest_pair(
    points: DataFrame,
    x: str = "x",
    y: str = "y",
    one_task: int = _ONE_TASK,
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """One row (x1, y1, x2, y2, distance), smaller point first; none below 2 points.

    Only hull vertices can be farthest apart, and only those that face opposite
    directions are compared.  Ties go to the smallest (x1, y1, x2, y2).
    ``on_bad='fail'`` refuses bad coordinates, ``observation`` counts them.
    """
    valid = points_only(checked(points, (x, y), on_bad, observation), x, y)
    left, count = hull_survivors(valid, one_task)
    if count > one_task:
        return farthest_by_edges(left, one_task)
    found = left.repartition(1).mapInArrow(_farthest, _PAIR)
    # only coincident points: the hull is one vertex, the pair has distance 0
    alone = left.agg(
        F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2")
    ).where("x1 = x2 AND y1 = y2")
    if alone.limit(1).count() == 1 and valid.limit(2).count() == 2:
        return alone.withColumn("distance", F.lit(0.0))
    return found
