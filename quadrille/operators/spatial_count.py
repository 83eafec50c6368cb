"""Number of targets held by each query box."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.predicates import box_of
from ..functions.shapes import checked, coordinate_columns
from ..plans import grid
from .spatial_join import as_boxes, matched, side_to_broadcast

# Cells per query side (as a power of two) when whole cells are counted.
_FINER = range(3, 6)
_FINEST = 8
# Points that may be compared on a border for the price of one row of a query's cells.
_BORDER_SHARE = 0.01
# Average number of queries over a point from which counting cells pays.
_OVERLAP = 32.0


def _cells_layout(points: DataFrame, ext: grid.Extents) -> grid.Layout:
    """Cells that keep the query side small enough to send.

    Else cells so small that the points on a query's border cost about what its cells there
    cost: with the root of the points a query is expected to hold, so that neither grows
    like queries times points.
    """
    layout = grid.fine_layout(ext, _FINER)
    if layout.query_cells <= grid._BROADCAST_ROWS:
        return layout
    area = (ext.xmax - ext.xmin) * (ext.ymax - ext.ymin)
    held = grid.in_window(points, layout).count() * min(1.0, ext.area / ext.rows / area if area > 0 else 1.0)
    finer = math.ceil(math.log2(max(1.0, _BORDER_SHARE * held)) / 2)
    return grid.plan_layout(ext, None, min(max(_FINER.start, finer), _FINEST))


def _count_by_cells(points: DataFrame, queries: DataFrame, ext: grid.Extents) -> DataFrame:
    """Cells strictly inside a query give their count; only cells on its border
    are joined with points.

    A cell between the end cells of a box holds only points of the box, because
    cells are monotone in the coordinate.
    """
    layout = _cells_layout(points, ext)
    side = side_to_broadcast("auto", layout, points, None)
    from_cells = grid.inner_counts(grid.cell_counts(points, layout), queries, layout)
    border = grid.meet(points, queries, layout, True, side, border=True)
    from_points = border.where(P.intersects(box_of("q_"), box_of("t_"))).select(
        F.col("q_qid").alias("qid"), F.col("t_n").alias("n")
    )
    return from_cells.unionByName(from_points)


def spatial_count(
    targets: DataFrame,
    queries: DataFrame,
    how: str = "inner",
    strategy: str = "auto",
    query_id: str = "id",
    target_columns: Sequence[str] | None = None,
    query_columns: Sequence[str] | None = None,
    on_bad: str = "drop",
    observation: Observation | None = None,
    query_observation: Observation | None = None,
) -> DataFrame:
    """Rows (qid, n): targets contained in or touching each query box.

    A point counts when it lies in the closed box.  A box counts when it lies
    inside or only touches; a partly overlapping or enclosing box does not.
    Queries without a target are absent, ``how='left'`` reports them with 0.

    strategy  ``broadcast``/``shuffle`` join and count; ``cells`` counts points per
              cell first and joins only along query borders; ``auto`` measures.
    ``on_bad='fail'`` refuses bad coordinates on either side; ``observation`` counts them
    among the targets, ``query_observation`` among the queries.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    targets = checked(targets, coordinate_columns(targets, target_columns), on_bad, observation)
    queries = checked(queries, coordinate_columns(queries, query_columns), on_bad, query_observation)
    t, points = as_boxes(targets, target_columns, [])
    q, _ = as_boxes(queries, query_columns, [(query_id, "qid")])
    ext = grid.measure(q)
    area = (ext.xmax - ext.xmin) * (ext.ymax - ext.ymin)
    if strategy == "cells" and not points:
        raise ValueError("strategy 'cells' needs point targets")
    if strategy == "auto" and points and not t.isStreaming and ext.area > _OVERLAP * area > 0:
        strategy = "cells"
    if ext.rows == 0:
        # of the targets, so that a stream stays one
        hits = t.where(F.lit(False)).select(
            F.lit(None).cast(q.schema["qid"].dataType).alias("qid"), F.lit(1).cast("long").alias("n")
        )
    elif strategy == "cells":
        hits = _count_by_cells(t.withColumn("n", F.lit(1).cast("long")), q, ext)
    else:
        pairs = matched(t, q, points, P.intersects if points else P.holds, strategy, ext, weigh=True)
        hits = pairs.select(F.col("q_qid").alias("qid"), F.col("t_n").alias("n"))
    counts = hits.groupBy("qid").agg(F.sum("n").alias("n"))
    if how == "left":
        everyone = queries.select(F.col(query_id).alias("asked")).distinct()
        counts = everyone.join(counts, F.col("asked").eqNullSafe(F.col("qid")), "left").select(
            F.col("asked").alias("qid"), F.coalesce("n", F.lit(0).cast("long")).alias("n")
        )
    return counts
