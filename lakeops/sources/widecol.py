"""Wide-column rows, stored tall: one line per cell (row_key, family, qualifier, value, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import nest_groups

# The fields of a cell.
CELL = ["family", "qualifier", "value", "timestamp"]


def key_filter(cells: DataFrame, prefix: str | None = None, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """A key prefix, else the half-open range ``[start, end)``.

    The prefix is a range too, so the files' min/max statistics can skip row groups.
    """
    key = F.col("row_key")
    if prefix:
        return cells.where(key.startswith(prefix))
    if start is not None:
        cells = cells.where(key >= start)
    if end is not None:
        cells = cells.where(key < end)
    return cells


def read_cells(cells: DataFrame, prefix: str | None = None, start: str | None = None,
               end: str | None = None, family: str | None = None,
               limit: int | None = None, mode: str = "STORE") -> DataFrame:
    """Matching cells. A family filter also drops rows left without cells; the limit counts
    rows in key order, and without one all rows come back."""
    found = key_filter(cells, prefix, start, end)
    if family is not None:
        found = found.where(F.col("family") == family)
    if mode == "FETCH_ONE":
        limit = 1
    if limit is None:
        return found
    first_keys = found.select("row_key").distinct().orderBy("row_key").limit(limit)
    return found.join(first_keys, "row_key", "left_semi")


def read_rows(cells: DataFrame, max_cells: int = 100_000, **selection) -> DataFrame:
    """``row_key`` with its nested cells; a row longer than ``max_cells`` comes in
    consecutive ``part`` s."""
    return nest_groups(read_cells(cells, **selection), ["row_key"], CELL,
                       ["family", "qualifier", "timestamp", "value"], "cells", max_cells)


def newest_cells(cells: DataFrame) -> DataFrame:
    """The newest version of each (row, family, qualifier)."""
    return (cells.groupBy("row_key", "family", "qualifier")
                 .agg(F.max_by("value", "timestamp").alias("value"),
                      F.max("timestamp").alias("timestamp")))
