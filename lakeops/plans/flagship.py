"""The flagship query: load, partition, write, list, select partitions, aggregate with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.partitions import (PARTITION, list_partitions, partition_by_time,
                                          select_partitions)
from lakeops.operators.sql import run_sql
from lakeops.operators.tables import write_table
from lakeops.plans.registry import query
from lakeops.session import fresh_database
from lakeops.sources.load import load


@query("partitioned_event_totals", """
  select event_type, count(*) as n, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents
  from events where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-09' group by 1""")
def partitioned_event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, f"{sf_dir}/events.parquet", "parquet").rows
    database = fresh_database(spark, "flagship")
    write_table(partition_by_time(events, "ts", "DAY"), f"{database}.events_by_day", partitioned=True)
    week = select_partitions(list_partitions(spark, f"{database}.events_by_day"), "DAY",
                             "2024-01-02T00:00:00", "2024-01-08T00:00:00")
    # partition ids are catalog metadata; as literals they prune the scan
    chosen = sorted(r[PARTITION] for r in week.collect())
    return run_sql(spark, """
        SELECT event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM events_by_day WHERE partition_id IN UNNEST(@ids) GROUP BY event_type""",
        params={"ids": chosen}, default_dataset=database).rows.select(
            "event_type", "n", F.col("cents").cast("bigint"))
