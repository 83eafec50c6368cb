"""Planar analytics on Spark DataFrames: points and axis-parallel rectangles."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

from .functions.predicates import register_sql_functions
from .operators.closest_pair import closest_pair
from .operators.convex_hull import convex_hull
from .operators.farthest_pair import farthest_pair
from .operators.range_query import range_query
from .operators.rect_union import rect_union
from .operators.spatial_count import spatial_count
from .operators.spatial_join import spatial_join
from .sources.text import (
    parse_boxes,
    parse_points,
    parse_rects,
    read_boxes,
    read_points,
    read_rects,
    read_window,
    to_lines,
    write_lines,
)

# Task functions travel with the task: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "closest_pair",
    "convex_hull",
    "farthest_pair",
    "parse_boxes",
    "parse_points",
    "parse_rects",
    "range_query",
    "read_boxes",
    "read_points",
    "read_rects",
    "read_window",
    "rect_union",
    "register_sql_functions",
    "spatial_count",
    "spatial_join",
    "to_lines",
    "write_lines",
]
