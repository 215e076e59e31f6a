"""Running SQL: result modes, typed parameters, flattening, paging and statistics."""

from __future__ import annotations

import datetime
import decimal
import json
import re
import time
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, types as T
from pyspark.sql import functions as F

from lakeops.operators.skew import number_rows
from lakeops.session import scratch_dir

# Result modes.
FETCH_TYPES = ("NONE", "FETCH", "FETCH_ONE", "STORE")
# Quoted text, quoted names and comments, which are never rewritten.
_QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/"
_SCALARS = (bool, int, float, str, bytes, bytearray, decimal.Decimal,
            datetime.date, datetime.datetime, datetime.timedelta)


@dataclass
class QueryResult:
    """``rows`` is lazy. ``size`` is known for stored or single rows and counted on demand else."""
    rows: DataFrame
    known_size: int | None = None
    uri: str | None = None

    @property
    def size(self) -> int:
        if self.known_size is None:
            self.known_size = self.rows.count()
        return self.known_size


def bind_parameters(params: dict) -> dict:
    """Check and convert named parameters.

    Scalars pass through. A list takes its type from its first element: empty lists, nulls
    and mixed types are refused. Every other object is sent as JSON text.
    """
    bound = {}
    for name, value in params.items():
        if value is None or isinstance(value, _SCALARS):
            bound[name] = value
        elif isinstance(value, (list, tuple)):
            if not value:
                raise ValueError(f"parameter {name}: an empty list has no element type")
            first = type(value[0])
            if any(v is None for v in value):
                raise ValueError(f"parameter {name}: null elements are not allowed")
            if any(type(v) is not first for v in value):
                raise ValueError(f"parameter {name}: elements must share one type")
            bound[name] = F.array(*[F.lit(v) for v in value])
        else:
            bound[name] = json.dumps(value, default=str)
    return bound


def named_parameters(sql: str) -> str:
    """``@p`` to ``:p`` and ``x IN UNNEST(@p)`` to ``array_contains(:p, x)``, outside quotes."""
    def swap(match: re.Match) -> str:
        return match.group(0) if match.group(1) is None else f":{match.group(1)}"
    def member(match: re.Match) -> str:
        if match.group(1) is None:
            return match.group(0)
        negation = "NOT " if match.group(2) else ""
        return f"{negation}array_contains(@{match.group(3)}, {match.group(1)})"
    sql = re.sub(_QUOTED + r"|([\w.]+)\s+(NOT\s+)?IN\s+UNNEST\s*\(\s*@(\w+)\s*\)", member, sql,
                 flags=re.S | re.I)
    return re.sub(_QUOTED + r"|(?<![\w@])@(\w+)", swap, sql, flags=re.S)


def as_script(sql: str) -> str:
    """Several statements become one compound statement, whose last result is returned."""
    bare = re.sub(_QUOTED, "x", sql, flags=re.S).strip()
    if ";" not in bare.rstrip("; \n\t") or re.match(r"(?i)begin\b", bare):
        return sql.strip().rstrip(";") if not re.match(r"(?i)begin\b", bare) else sql
    return f"BEGIN\n{sql.strip().rstrip(';')};\nEND"


def run_sql(spark: SparkSession, sql: str, fetch_type: str = "FETCH", *, params: dict | None = None,
            destination: str | None = None, default_dataset: str | None = None,
            write: str = "WRITE_EMPTY", create: str = "CREATE_IF_NEEDED", partition_column: str | None = None,
            granularity: str = "DAY", cluster_by: list[str] = (), schema_update: list[str] = (),
            partition_range: tuple[int, int, int] | None = None) -> QueryResult:
    """Run a statement or script.

    FETCH hands the rows on, FETCH_ONE the first one, STORE writes them to files and reports
    place and count, NONE runs for effect only. A destination table receives the rows first; it
    may be partitioned by the time in ``partition_column``, or by its whole numbers in ranges of ``partition_range`` (start, end,
    interval), clustered, and take new fields.
    """
    if fetch_type not in FETCH_TYPES:
        raise ValueError(f"fetch type is one of {FETCH_TYPES}")
    text = as_script(named_parameters(sql) if params else sql)
    before = spark.catalog.currentDatabase()
    if default_dataset:
        spark.catalog.setCurrentDatabase(default_dataset)
    try:
        # names are resolved here, so the caller's own database can come back at once
        rows = spark.sql(text, args=bind_parameters(params)) if params else spark.sql(text)
    finally:
        if default_dataset:
            spark.catalog.setCurrentDatabase(before)
    if destination:
        from lakeops.operators.partitions import partition_by_range, partition_by_time
        from lakeops.operators.tables import write_table
        if partition_range and not partition_column:
            raise ValueError("a range partitioning needs its column")
        if partition_range:
            rows = partition_by_range(rows, partition_column, *partition_range)
        elif partition_column:
            rows = partition_by_time(rows, partition_column, granularity)
        write_table(rows, destination, write=write, create=create, partitioned=bool(partition_column),
                    cluster_by=cluster_by, schema_update=schema_update)
        rows = spark.table(destination)
    if fetch_type == "STORE":
        return store(rows)
    if fetch_type == "FETCH_ONE":
        first = rows.head(1)
        return QueryResult(spark.createDataFrame(first, rows.schema), known_size=len(first))
    if fetch_type == "NONE" and not destination and rows.columns:
        rows.write.format("noop").mode("overwrite").save()
    return QueryResult(rows)


def store(rows: DataFrame, fmt: str = "parquet") -> QueryResult:
    """Write a result to files; the count comes from the stored files, not from the job."""
    spark = rows.sparkSession
    uri = scratch_dir(spark, "result")
    rows.write.format(fmt).save(uri)
    stored = spark.read.schema(rows.schema).format(fmt).load(uri)
    return QueryResult(stored, known_size=stored.count(), uri=uri)


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested fields become columns and one repeated field per level becomes rows.

    Two repeated fields side by side would multiply each other, so they are refused.
    """
    while True:
        structs = [f for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
        if structs:
            df = df.select(*[c for f in df.schema.fields for c in _opened(f, separator)])
            continue
        arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        if not arrays:
            return df
        if len(arrays) > 1:
            raise ValueError(f"cannot flatten sibling repeated fields {arrays}")
        df = df.select(*[F.explode_outer(f"`{c}`").alias(c) if c in arrays else F.col(f"`{c}`")
                         for c in df.columns])


def _opened(field: T.StructField, separator: str) -> list[Column]:
    column = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, T.StructType):
        return [column]
    return [column.getField(f.name).alias(f"{field.name}{separator}{f.name}")
            for f in field.dataType.fields]


def next_page(df: DataFrame, key: str, size: int, after=None) -> DataFrame:
    """Keyset paging over a unique key: the page that follows the key ``after``."""
    rest = df if after is None else df.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(size)


def number_pages(df: DataFrame, key: str, size: int) -> DataFrame:
    """Every row with its 1-based page, for reading or storing all pages at once."""
    numbered = number_rows(df, [key], "_row")
    return numbered.withColumn("page", F.floor(F.col("_row") / size) + 1).drop("_row")


def query_statistics(df: DataFrame, partition_column: str | None = None, label: str | None = None,
                     scan: DataFrame | None = None, dml_rows: int | None = None) -> DataFrame:
    """Rows and partitions of a result as one tagged row.

    ``scan``, a frame that reads files directly, adds the files and bytes it touches after
    pruning; ``dml_rows`` adds the affected rows of a change.
    """
    partitions = F.count_distinct(partition_column) if partition_column else F.lit(0)
    stats = df.agg(F.count(F.lit(1)).alias("rows"), partitions.cast("bigint").alias("partitions"))
    if scan is not None:
        files = scanned_files(scan).agg(F.count(F.lit(1)).alias("input_files"),
                                        F.coalesce(F.sum("bytes"), F.lit(0)).alias("input_bytes"))
        # one row each
        stats = stats.withColumn("_one", F.lit(1)).join(files.withColumn("_one", F.lit(1)), "_one").drop("_one")
    if dml_rows is not None:
        stats = stats.withColumn("dml_rows", F.lit(dml_rows).cast("bigint"))
    return stats.withColumn("label", F.lit(label).cast("string"))


def scanned_files(df: DataFrame) -> DataFrame:
    """Distinct input files with their sizes; ``df`` must read files directly."""
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_size").alias("bytes")).distinct()


@dataclass
class RunStatistics:
    """What one run did, gathered while it ran. ``bytes`` are those of the files it wrote."""
    rows: int
    partitions: int | None
    bytes: int
    files: int
    seconds: float
    dml_rows: int | None = None
    label: str | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(asdict(self).values())],
            "rows bigint, partitions bigint, bytes bigint, files bigint, seconds double, dml_rows bigint, label string")


def run_observed(df: DataFrame, path: str | None = None, fmt: str = "parquet", partition_column: str | None = None,
                 label: str | None = None, changed: Column | None = None) -> tuple[DataFrame, RunStatistics]:
    """Write a result and gather its statistics in the same run, by observation: the plan is evaluated once.

    ``partition_column`` holds ids of partitions, of which a table has a bounded number; those touched are counted exactly.
    ``changed`` tells the rows that a change affected. Size and number of files come from a listing of what was written.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark, "result")
    seen = [F.count(F.lit(1)).alias("rows")]
    if partition_column:
        seen.append(F.size(F.collect_set(F.coalesce(F.col(partition_column).cast("string"), F.lit("\0")))).alias("partitions"))
    if changed is not None:
        seen.append(F.count_if(changed).alias("dml_rows"))
    run = Observation()
    began = time.monotonic()
    df.observe(run, *seen).write.format(fmt).save(path)
    seconds = time.monotonic() - began
    written = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                    .agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first())
    stats = RunStatistics(run.get["rows"], run.get.get("partitions"), written[0], written[1], seconds, run.get.get("dml_rows"), label)
    return spark.read.schema(df.schema).format(fmt).load(path), stats
