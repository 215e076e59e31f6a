"""Extracts: a table or result written as CSV, JSON, Parquet, ORC or Avro files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.sources.load import input_files, raw_avro_types


def extract(df: DataFrame, uris: str | list[str], fmt: str = "csv", *, delimiter: str = ",",
            header: bool = True, compression: str | None = None, use_logical_types: bool = True,
            overwrite: bool = False) -> DataFrame:
    """Write ``df`` as files; returns the file count and bytes per directory.

    Several URIs share the rows between them: each row goes to one, by its hash. A trailing
    ``*`` asks for shards, which Spark writes anyway.
    """
    spark = df.sparkSession
    targets = [u.rstrip("*").rstrip("/") for u in ([uris] if isinstance(uris, str) else uris)]
    fmt = fmt.lower()
    if fmt == "avro" and not use_logical_types:
        df = raw_avro_types(df)
    share = F.pmod(F.xxhash64(F.to_json(F.struct("*"))), F.lit(len(targets)))
    counts = None
    for position, target in enumerate(targets):
        rows = df if len(targets) == 1 else df.where(share == position)
        writer = rows.write.format(fmt).mode("overwrite" if overwrite else "errorifexists")
        if fmt == "csv":
            writer = writer.option("sep", delimiter).option("header", header).option("escape", '"')
        if compression:
            writer = writer.option("compression", compression.lower())
        try:
            writer.save(target)
        except AnalysisException as error:
            if fmt == "avro":
                raise RuntimeError("Avro files need the spark-avro package on the classpath") from error
            raise
        line = input_files(spark, [target]).agg(
            F.lit(target).alias("uri"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        counts = line if counts is None else counts.unionByName(line)
    return counts
