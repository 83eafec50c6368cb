"""Predicates on points and closed axis-parallel boxes, as Column expressions.

A box is four columns; a point is the box whose corners coincide.  All borders
belong to the box.  ``meet_inside`` is the building block that tells contact on
the border from overlap of the interiors.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class Box(NamedTuple):
    xmin: Column
    ymin: Column
    xmax: Column
    ymax: Column


def box_from_corners(x1: Column, y1: Column, x2: Column, y2: Column) -> Box:
    """Box spanned by any two opposite corners."""
    return Box(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2))


def box_from_point(x: Column, y: Column) -> Box:
    return Box(x, y, x, y)


def box_of(prefix: str = "") -> Box:
    """Box made of the columns ``<prefix>xmin`` ... ``<prefix>ymax``."""
    return Box(*(F.col(prefix + c) for c in Box._fields))


def is_finite(*coords: Column) -> Column:
    """True when every coordinate is a finite number; null for null.

    Spark sorts NaN above infinity, so one comparison rejects both.
    """
    return reduce(and_, (F.abs(c) < F.lit(math.inf) for c in coords))


def point_in_box(x: Column, y: Column, b: Box) -> Column:
    return x.between(b.xmin, b.xmax) & y.between(b.ymin, b.ymax)


def intersects(a: Box, b: Box) -> Column:
    """The closed sets share at least one point."""
    return (a.xmin <= b.xmax) & (b.xmin <= a.xmax) & (a.ymin <= b.ymax) & (b.ymin <= a.ymax)


def meet_inside(a: Box, b: Box) -> Column:
    """The overlap is more than border contact."""
    return (a.xmin < b.xmax) & (b.xmin < a.xmax) & (a.ymin < b.ymax) & (b.ymin < a.ymax)


def contains(a: Box, b: Box) -> Column:
    """All of ``b`` lies in ``a`` and not only on the border of ``a``.

    For a point this means strictly inside.
    """
    inside = (a.xmin <= b.xmin) & (b.xmax <= a.xmax) & (a.ymin <= b.ymin) & (b.ymax <= a.ymax)
    return inside & meet_inside(a, b)


def within(a: Box, b: Box) -> Column:
    return contains(b, a)


def equals(a: Box, b: Box) -> Column:
    return (a.xmin == b.xmin) & (a.ymin == b.ymin) & (a.xmax == b.xmax) & (a.ymax == b.ymax)


def touches(a: Box, b: Box) -> Column:
    """The closed sets meet, the interiors do not."""
    return intersects(a, b) & ~meet_inside(a, b)


def holds(a: Box, b: Box) -> Column:
    """Counting rule of ``spatial_count``: contained or touching.

    For points it equals ``point_in_box``; a partly overlapping box is not held.
    """
    return contains(a, b) | touches(a, b)


_SQL_ARGS = ", ".join(f"{s}{c} DOUBLE" for s in ("a_", "b_") for c in ("x1", "y1", "x2", "y2"))
# any two opposite corners make a box, as everywhere
_SQL_MEET = (
    "least(a_x1, a_x2) < greatest(b_x1, b_x2) AND least(b_x1, b_x2) < greatest(a_x1, a_x2)"
    " AND least(a_y1, a_y2) < greatest(b_y1, b_y2) AND least(b_y1, b_y2) < greatest(a_y1, a_y2)"
)
_SQL_CLOSED = _SQL_MEET.replace("<", "<=")


def _sql_inside(a: str, b: str) -> str:
    return " AND ".join(
        f"least({a}_{c}1, {a}_{c}2) <= least({b}_{c}1, {b}_{c}2) AND greatest({b}_{c}1, {b}_{c}2) <= greatest({a}_{c}1, {a}_{c}2)"
        for c in "xy"
    )


_SQL_FUNCTIONS = {
    "box_intersects": _SQL_CLOSED,
    "box_contains": f"{_sql_inside('a', 'b')} AND {_SQL_MEET}",
    "box_within": f"{_sql_inside('b', 'a')} AND {_SQL_MEET}",
    "box_equals": f"{_sql_inside('a', 'b')} AND {_sql_inside('b', 'a')}",
    "box_touches": f"{_SQL_CLOSED} AND NOT ({_SQL_MEET})",
    "box_holds": f"({_sql_inside('a', 'b')} AND {_SQL_MEET}) OR ({_SQL_CLOSED} AND NOT ({_SQL_MEET}))",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Offer the predicates to ``spark.sql``; Catalyst inlines their bodies."""
    for name, body in _SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({_SQL_ARGS}) RETURNS BOOLEAN RETURN {body}"
        )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION point_in_box(x DOUBLE, y DOUBLE, x1 DOUBLE,"
        " y1 DOUBLE, x2 DOUBLE, y2 DOUBLE) RETURNS BOOLEAN RETURN x BETWEEN least(x1, x2)"
        " AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)"
    )
    return [*_SQL_FUNCTIONS, "point_in_box"]
