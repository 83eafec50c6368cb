"""Column conventions of the DataFrames that the operators take.

points  ``x, y``
boxes   ``xmin, ymin, xmax, ymax`` or any two opposite corners ``x1, y1, x2, y2``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .predicates import Box, box_from_corners, box_from_point, is_finite

_BOX = ("xmin", "ymin", "xmax", "ymax")
_CORNERS = ("x1", "y1", "x2", "y2")
_POINT = ("x", "y")


def coordinate_columns(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[str, ...]:
    """The 2 (points) or 4 (boxes) coordinate columns of ``df``."""
    if columns is not None:
        if len(columns) not in (2, 4):
            raise ValueError("give 2 columns for points or 4 for boxes")
        return tuple(columns)
    for names in (_BOX, _CORNERS, _POINT):
        if set(names) <= set(df.columns):
            return names
    raise ValueError(f"no coordinate columns among {df.columns}")


def to_box(columns: Sequence[str]) -> Box:
    """Normalised box expression over coordinate columns."""
    cols = [F.col(c).cast("double") for c in columns]
    if len(cols) == 2:
        return box_from_point(*cols)
    return box_from_corners(*cols)


def keep_valid(
    df: DataFrame,
    columns: Sequence[str],
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Remove (or refuse) rows whose coordinates are null, NaN or infinite.

    ``observation`` receives ``bad_rows`` and ``rows`` when the result is computed.
    """
    good = is_finite(*(F.col(c).cast("double") for c in columns))
    if observation is not None:
        bad = ~F.coalesce(good, F.lit(False))
        df = df.observe(
            observation, F.count_if(bad).alias("bad_rows"), F.count(F.lit(1)).alias("rows")
        )
    if on_bad == "drop":
        return df.where(good)
    if on_bad == "fail":
        text = F.concat_ws(",", *(F.col(c).cast("string") for c in columns))
        error = F.raise_error(F.concat(F.lit("bad coordinates: "), text)).cast("boolean")
        return df.where(F.when(good, F.lit(True)).otherwise(error))
    raise ValueError("on_bad is 'drop' or 'fail'")


def checked(
    df: DataFrame,
    columns: Sequence[str],
    on_bad: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """``df``, once its coordinates were looked at if the caller asked for that.

    ``fail`` raises if a coordinate is null, NaN or infinite; ``observation`` receives
    ``bad_rows`` and ``rows``.  Either costs a pass over the coordinates beforehand, so
    the figures are whole whatever an operator prunes or reads twice.  A stream is
    checked batch by batch instead.
    """
    if on_bad not in ("drop", "fail"):
        raise ValueError("on_bad is 'drop' or 'fail'")
    if on_bad == "drop" and observation is None:
        return df
    if df.isStreaming:
        return keep_valid(df, columns, on_bad, observation)
    numbers = [F.col(c).cast("double") for c in columns]
    bad = ~F.coalesce(is_finite(*numbers), F.lit(False))
    text = F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("null")) for c in numbers))
    looked = df.select(bad.alias("bad"), F.when(bad, text).alias("text"))
    if observation is not None:
        looked = looked.observe(
            observation, F.count_if("bad").alias("bad_rows"), F.count(F.lit(1)).alias("rows")
        )
    found = looked.agg(F.count_if("bad").alias("n"), F.min("text").alias("example")).first()
    if on_bad == "fail" and found.n:
        raise ValueError(f"{found.n} rows with bad coordinates, one of them {found.example}")
    return df


def points_only(df: DataFrame, x: str, y: str, *carry: Column) -> DataFrame:
    """Valid points as double columns ``x, y`` plus the carried columns."""
    return keep_valid(df, (x, y)).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *carry
    )
