"""Points inside one closed window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.shapes import checked


def range_query(
    points: DataFrame,
    window: Sequence[float],
    x: str = "x",
    y: str = "y",
    columns: Sequence[str] | None = ("id",),
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Rows of ``points`` in ``window = (xa, ya, xb, yb)``, any opposite corners.

    The bounds are literals: a Parquet scan gets them as pushed filters and reads
    only the columns needed.  NaN and null never match.  ``columns=None`` keeps
    all columns.  Works on streaming DataFrames as well.
    ``on_bad='fail'`` refuses bad coordinates, ``observation`` counts them.
    """
    xa, ya, xb, yb = (float(v) for v in window)
    hit = checked(points, (x, y), on_bad, observation).where(
        F.col(x).between(min(xa, xb), max(xa, xb)) & F.col(y).between(min(ya, yb), max(ya, yb))
    )
    return hit if columns is None else hit.select(*columns)
