"""Cost report over a job history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.labels import clean_label, cost_usd, readable_size


def cost_report(jobs: DataFrame, label: str, size: str) -> DataFrame:
    """Bytes, readable size and price per cleaned label."""
    return (jobs.groupBy(clean_label(F.col(label)).alias("label"))
                .agg(F.count(F.lit(1)).alias("jobs"), F.sum(size).cast("bigint").alias("bytes"))
                .withColumn("size", readable_size(F.col("bytes")))
                .withColumn("cost_usd", cost_usd(F.col("bytes"))))
