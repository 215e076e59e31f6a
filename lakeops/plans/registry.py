"""The list of registered queries, each with its SQL counterpart where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeops.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables hold zone-free times; UTC keeps casts between the two kinds exact. Casts keep
            # the zone that they were resolved with, so the caller's own comes back afterwards.
            zone = spark.conf.get("spark.sql.session.timeZone")
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            try:
                ship_package(spark)
                return function(spark, sf_dir)
            finally:
                spark.conf.set("spark.sql.session.timeZone", zone)
        run.__name__ = name
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return function
    return keep
