"""Polls and watches: SQL results, cell look-backs, metric filters, log routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.sql import run_sql
from lakeops.sources.series import DEFAULT_WINDOW, query_series
from lakeops.sources.widecol import key_filter


def watch_sql(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame | None:
    """One poll: the rows, or None when there are none."""
    rows = run_sql(spark, sql, "FETCH", params=params).rows
    return rows if rows.head(1) else None


def watch_stream(base: DataFrame, view: str, sql: str, emit: Callable[[DataFrame, int], None],
                 checkpoint: str) -> StreamingQuery:
    """Run the SQL over each new batch of the base table; emit only when it returns rows."""
    def check(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        rows = batch.sparkSession.sql(sql)
        if rows.head(1):
            emit(rows, batch_id)
    return (base.writeStream.foreachBatch(check).trigger(availableNow=True)
                .option("checkpointLocation", checkpoint).start())


def watch_cells(cells: DataFrame, family: str | None = None, now_micros: int | None = None,
                look_back_seconds: int | None = None, prefix: str | None = None,
                start: str | None = None, end: str | None = None,
                max_rows: int | None = None) -> DataFrame:
    """One poll: cells of the newest window; of the first ``max_rows`` rows only if a number is given.

    The time bound applies only together with a family, and both select cells.
    """
    found = key_filter(cells, prefix, start, end)
    if family is not None:
        found = found.where(F.col("family") == family)
        if look_back_seconds is not None:
            found = found.where(F.col("timestamp") >= now_micros - look_back_seconds * 1_000_000)
    if max_rows is None:
        return found
    keys = found.select("row_key").distinct().orderBy("row_key").limit(max_rows)
    return found.join(keys, "row_key", "left_semi")


def watch_cells_stream(cells: DataFrame, family: str, look_back: str = "1 day") -> DataFrame:
    """Streaming form: every cell once, although polls overlap. ``timestamp`` is in µs."""
    return (cells.where(F.col("family") == family)
                 .withColumn("_time", F.timestamp_micros("timestamp"))
                 .withWatermark("_time", look_back)
                 .dropDuplicatesWithinWatermark(["row_key", "family", "qualifier", "timestamp"])
                 .drop("_time"))


def watch_series(points: DataFrame, condition: Column | str, now: Column,
                 window: str = DEFAULT_WINDOW) -> DataFrame | None:
    """The matching series, or None when no series matches."""
    found = query_series(points, condition, now, window)
    return found if found.head(1) else None


def push_points(values: DataFrame, now: Column, window: str = "INTERVAL 1 MINUTE") -> DataFrame:
    """``metric_type, labels, kind, value`` to points: a gauge covers one instant, the other
    kinds the window up to now; times are whole seconds."""
    at = F.date_trunc("SECOND", now)
    kind = F.coalesce("kind", F.lit("GAUGE"))
    return values.select(
        "metric_type", "labels", kind.alias("kind"), F.col("value").cast("double").alias("value"),
        F.when(kind == "GAUGE", at).otherwise(F.date_trunc("SECOND", now - F.expr(window))).alias("start_ts"),
        at.alias("end_ts"))


# Log level of each severity; every other severity is info.
LOG_LEVELS = {"DEBUG": "debug", "WARNING": "warn", "ERROR": "error", "CRITICAL": "error",
              "ALERT": "error", "EMERGENCY": "error"}


def log_level(severity: Column) -> Column:
    level = F.lit("info")
    for name, value in LOG_LEVELS.items():
        level = F.when(severity == name, value).otherwise(level)
    return level


def route_logs(logs: DataFrame, path: str, checkpoint: str | None = None,
               severity: str = "severity") -> StreamingQuery | None:
    """Write log entries below one folder per level; a stream is drained."""
    routed = logs.withColumn("level", log_level(F.col(severity)))
    if not logs.isStreaming:
        routed.write.partitionBy("level").parquet(path)
        return None
    query = (routed.writeStream.format("parquet").partitionBy("level").trigger(availableNow=True)
                   .option("checkpointLocation", checkpoint).start(path))
    query.awaitTermination()
    return query
