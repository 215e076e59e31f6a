"""Partition layout and maintenance of catalog tables.

A partitioned table carries its partition id as the column ``partition_id``; ids are text of
one width per granularity, so pruning and range tests work on the directory names alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import partition_ids as ids

PARTITION = "partition_id"


class NoPartitionsError(ValueError):
    """The range holds no partition."""


def partition_by_time(df: DataFrame, field: str | None, granularity: str = "DAY",
                      ingested_at=None) -> DataFrame:
    """Adds the id column. Without a field, the ingestion time decides."""
    if field is None:
        moment = F.lit(ingested_at) if ingested_at is not None else F.current_timestamp()
    else:
        moment = F.col(field)
    return df.withColumn(PARTITION, ids.time_id(moment, granularity))


def partition_by_range(df: DataFrame, field: str, start: int, end: int, interval: int) -> DataFrame:
    return df.withColumn(PARTITION, ids.range_id(F.col(field), start, end, interval))


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition ids from the catalog; no data is read."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    return listed.select(F.regexp_extract("partition", f"{PARTITION}=([^/]+)", 1).alias(PARTITION))


def count_partitions(df: DataFrame) -> DataFrame:
    """Ids present in rows that already carry the id column, with their row counts."""
    return df.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("rows"))


def select_partitions(partitions: DataFrame, granularity: str, low: str, high: str) -> DataFrame:
    """Ids whose start lies in the inclusive range."""
    return partitions.where(ids.within(F.col(PARTITION), granularity, low, high))


def _chosen(spark: SparkSession, table: str, granularity: str, low: str, high: str) -> list[str]:
    # catalog metadata: one short id per partition, needed as literals in DDL
    chosen = select_partitions(list_partitions(spark, table), granularity, low, high)
    return sorted(r[0] for r in chosen.collect())


def copy_partitions(spark: SparkSession, source: str, target: str, granularity: str, low: str,
                    high: str, *, skip_empty: bool = False, write: str = "WRITE_EMPTY",
                    create: str = "CREATE_IF_NEEDED") -> list[str]:
    """Copies the partitions of a range; returns their ids."""
    from lakeops.operators.tables import write_table
    chosen = _chosen(spark, source, granularity, low, high)
    if not chosen:
        if skip_empty:
            return []
        raise NoPartitionsError(f"no partition of {source} between {low} and {high}")
    rows = spark.table(source).where(F.col(PARTITION).isin(chosen))
    write_table(rows, target, write=write, create=create, partitioned=True)
    return chosen


def delete_partitions(spark: SparkSession, table: str, granularity: str, low: str,
                      high: str) -> list[str]:
    """Drops the partitions of a range in one statement; a vanished one is an error."""
    chosen = _chosen(spark, table, granularity, low, high)
    drop_partitions(spark, table, chosen)
    return chosen


def drop_partitions(spark: SparkSession, table: str, chosen: list[str]) -> None:
    if chosen:
        specs = ", ".join(f"PARTITION ({PARTITION} = '{c}')" for c in chosen)
        spark.sql(f"ALTER TABLE {table} DROP {specs}")
