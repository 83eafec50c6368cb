"""Text folders as streams.

The range query, the join and the count with static queries need no state of
their own: pass the streaming DataFrame to ``range_query``, ``spatial_join`` or
``spatial_count`` (the last one in update or complete mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.text import parse_boxes, parse_points


def _lines(spark: SparkSession, folder: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def stream_points(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None, **options
) -> DataFrame:
    """New files of ``folder`` as points; options as in ``parse_points``."""
    return parse_points(_lines(spark, folder, files_per_trigger), **options)


def stream_boxes(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None, **options
) -> DataFrame:
    """New files of ``folder`` as boxes; options as in ``parse_boxes``."""
    return parse_boxes(_lines(spark, folder, files_per_trigger), **options)
