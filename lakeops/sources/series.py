"""Time series points: ``{metric_type, labels, kind, value, start_ts, end_ts}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import nest_groups

# Fixed value: the default look-back.
DEFAULT_WINDOW = "INTERVAL 5 MINUTES"


def points_in_window(points: DataFrame, condition: Column | str, now: Column,
                     window: str = DEFAULT_WINDOW) -> DataFrame:
    """Points matching the filter whose end lies in ``[now - window, now]``."""
    return (points.where(condition)
                  .where(F.col("end_ts").between(now - F.expr(window), now)))


def query_series(points: DataFrame, condition: Column | str, now: Column,
                 window: str = DEFAULT_WINDOW, max_points: int = 100_000) -> DataFrame:
    """One row per series (metric and labels) with its points, oldest first.

    Labels are a map, which cannot be a grouping key, so the sorted entries stand for it.
    """
    found = points_in_window(points, condition, now, window).withColumn(
        "labels", F.array_sort(F.map_entries("labels")))
    nested = nest_groups(found, ["metric_type", "labels"], ["start_ts", "end_ts", "value"],
                         ["end_ts", "start_ts", "value"], "points", max_points)
    return nested.withColumn("labels", F.map_from_entries("labels"))
