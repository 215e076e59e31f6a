"""Importing this module registers the queries of this package, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import queries as _queries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = _queries.QUERIES
ORACLES: dict[str, str] = _queries.ORACLES
