"""Importing this module registers every query."""

from lakeops.plans import (  # noqa: F401
    flagship, load_queries, object_queries, sql_queries, stream_queries, table_queries)
from lakeops.plans.registry import ORACLES, QUERIES  # noqa: F401
