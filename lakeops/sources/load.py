"""File loads under a declared schema, with bad-record budgets and load statistics.

CSV and JSON lines are parsed once. The parsed rows are staged as Parquet, split by a
``_bad`` flag, so counting bad rows, checking the budget and reading good rows never parse
the text again. Parquet, ORC and Avro files carry their own types and are not staged.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from lakeops.functions.schema import missing_required, relaxed, to_struct_type
from lakeops.operators.skew import join_small
from lakeops.session import materialise, scratch_dir

RAW = "_raw_record"
# Stands for "no token here"; it cannot occur in decoded text files.
_ABSENT = "\u0000"


class BadRecordsError(ValueError):
    """More bad records than the budget allows."""

    def __init__(self, found: int, allowed: int):
        super().__init__(f"{found} bad records, {allowed} allowed")
        self.found = found


class EmptyInputError(ValueError):
    """The input holds no bytes at all."""


@dataclass(frozen=True)
class CsvOptions:
    delimiter: str = ","
    quote: str = '"'
    encoding: str = "UTF-8"
    skip_leading_rows: int = 0
    allow_quoted_newlines: bool = False
    allow_jagged_rows: bool = False

    def __post_init__(self):
        if self.encoding not in ("UTF-8", "ISO-8859-1"):
            raise ValueError("encoding is UTF-8 or ISO-8859-1")
        if self.skip_leading_rows < 0:
            raise ValueError("skip_leading_rows cannot be negative")

    def reader(self) -> dict[str, str]:
        return {"sep": self.delimiter, "quote": self.quote, "escape": self.quote,
                "encoding": self.encoding, "multiLine": str(self.allow_quoted_newlines).lower(),
                "header": str(self.skip_leading_rows == 1).lower(), "enforceSchema": "true"}


@dataclass
class LoadResult:
    rows: DataFrame
    bad: DataFrame
    stats: DataFrame
    schema: T.StructType
    duration_ms: int = field(default=0)


def check_uris(paths: str | list[str]) -> list[str]:
    """At most one ``*`` per path, and not in the bucket (the first path segment)."""
    uris = [paths] if isinstance(paths, str) else list(paths)
    if not uris:
        raise ValueError("no paths to load")
    for uri in uris:
        if uri.count("*") > 1:
            raise ValueError(f"only one * is allowed: {uri}")
        bucket = re.sub(r"^[a-zA-Z0-9+.-]+:/*", "", uri).lstrip("/").split("/", 1)
        if "*" in bucket[0] and len(bucket) > 1:
            raise ValueError(f"* is not allowed in the bucket: {uri}")
    return uris


def input_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per input file; the content column is never read."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


# ---------------------------------------------------------------- CSV

def read_csv_flagged(spark: SparkSession, paths: list[str], schema: T.StructType,
                     options: CsvOptions, ignore_unknown_values: bool = False) -> DataFrame:
    """Typed rows plus ``_bad`` and the raw text of every record the reader refused.

    The reader marks short, long and unparsable rows alike; only those rows are split into
    tokens again to tell the cases apart.
    """
    data = relaxed(schema)
    reader = (spark.read.options(**options.reader())
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
              .option("columnPruning", "false")
              .schema(T.StructType([*data.fields, T.StructField(RAW, T.StringType())])))
    rows = reader.csv(paths)
    if options.skip_leading_rows > 1:
        rows = _without_leading_rows(rows, options.skip_leading_rows)
    width = len(data.fields)
    tokens = F.from_csv(
        F.col(RAW), ", ".join(f"t{i} string" for i in range(width + 1)),
        {"sep": options.delimiter, "quote": options.quote, "escape": options.quote,
         "nullValue": _ABSENT, "mode": "PERMISSIVE"})
    rows = rows.withColumn("_tokens", F.when(F.col(RAW).isNotNull(), tokens))
    token = [F.col("_tokens").getField(f"t{i}") for i in range(width + 1)]
    unparsed = reduce(or_, [
        token[i].isNotNull() & (token[i] != "") & F.col(f"`{f.name}`").isNull()
        for i, f in enumerate(data.fields)])
    # empty last tokens come back null too, so fields are counted by the delimiters outside of quotes
    mark = re.escape(options.quote)
    bare = F.regexp_replace(RAW, f"{mark}(?:[^{mark}]|{mark}{mark})*{mark}", "") if options.quote else F.col(RAW)
    delimiters = (F.length(bare) - F.length(F.replace(bare, F.lit(options.delimiter), F.lit("")))) / len(options.delimiter)
    short, long = delimiters < width - 1, delimiters > width - 1
    marks = F.length(RAW) - F.length(F.replace(F.col(RAW), F.lit(options.quote), F.lit("")))
    refused = unparsed | ~(short | long) | (marks % 2 == 1)
    if not options.allow_jagged_rows:
        refused = refused | short
    if not ignore_unknown_values:
        refused = refused | long
    bad = (F.col(RAW).isNotNull() & F.coalesce(refused, F.lit(True))) | missing_required(schema)
    return rows.withColumn("_bad", F.coalesce(bad, F.lit(True))).drop("_tokens")


def _without_leading_rows(rows: DataFrame, skip: int) -> DataFrame:
    """Drop the first ``skip`` records of every file; blank lines are no records and do not count.

    Records are staged once with their place in the reading task. Leading records can only
    sit in the split that starts at byte 0, so the smallest place there is the file's start.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "skip")
    (rows.select("*", F.col("_metadata.file_path").alias("_file"),
                 (F.col("_metadata.file_block_start") == 0).alias("_first"))
         .withColumn("_place", F.monotonically_increasing_id())
         .write.parquet(path))
    placed = spark.read.parquet(path)
    starts = materialise(placed.where("_first").groupBy("_file")
                               .agg(F.min("_place").alias("_start")), "starts")
    # only records of first splits can lead, so the others need no join
    first = join_small(placed.where("_first"), starts, ["_file"]).where(
        F.col("_place") >= F.col("_start") + skip)
    extra = ["_file", "_first", "_place"]
    return first.drop("_start", *extra).unionByName(placed.where(~F.col("_first")).drop(*extra))


# ---------------------------------------------------------------- JSON lines

def unknown_keys(value: Column, schema: T.StructType) -> Column:
    """True when a parsed JSON object holds a key outside the schema, at any depth."""
    fields = value.try_cast("map<string,variant>")
    extra = F.size(F.array_except(F.map_keys(fields), F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>"))) > 0
    for f in schema.fields:
        inner = F.element_at(fields, f.name)
        if isinstance(f.dataType, T.StructType):
            extra = extra | F.coalesce(unknown_keys(inner, f.dataType), F.lit(False))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            element = f.dataType.elementType
            extra = extra | F.coalesce(F.exists(inner.try_cast("array<variant>"), lambda e: unknown_keys(e, element)), F.lit(False))
    return F.coalesce(extra, F.lit(False))


def _unknown_in_text(text: Column, schema: T.StructType) -> Column:
    """The same for lines that have no parsed form, such as those that repeat a key; at the top level."""
    return F.coalesce(F.size(F.array_except(F.json_object_keys(text), F.array(*[F.lit(f.name) for f in schema.fields]))) > 0, F.lit(False))


def read_json_flagged(spark: SparkSession, paths: list[str], schema: T.StructType,
                      ignore_unknown_values: bool = False) -> DataFrame:
    data = relaxed(schema)
    parsed = F.from_json(
        F.col("value"), T.StructType([*data.fields, T.StructField(RAW, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW})
    # beside the typed reading, one parse of each line serves the comparison of keys at all depths
    keys = [] if ignore_unknown_values else [F.try_parse_json("value").alias("v")]
    rows = spark.read.text(paths).where(F.trim("value") != "").select(parsed.alias("r"), "value", *keys)
    bad = F.col("r").isNull() | F.col("r").getField(RAW).isNotNull()
    if not ignore_unknown_values:
        bad = bad | F.when(F.col("v").isNotNull(), unknown_keys(F.col("v"), schema)).otherwise(
            _unknown_in_text(F.col("value"), schema))
    flat = rows.select(*[F.col("r").getField(f.name).alias(f.name) for f in data.fields],
                       bad.alias("_bad"), "value")
    broken = F.coalesce(F.col("_bad") | missing_required(schema), F.lit(True))
    return (flat.withColumn("_bad", broken)
                .withColumn(RAW, F.when(F.col("_bad"), F.col("value"))).drop("value"))


# ---------------------------------------------------------------- typed formats

def read_avro(spark: SparkSession, paths: list[str], use_logical_types: bool = True) -> DataFrame:
    try:
        rows = spark.read.format("avro").load(paths)
    except AnalysisException as error:
        raise RuntimeError("Avro files need the spark-avro package on the classpath") from error
    return rows if use_logical_types else raw_avro_types(rows)


def raw_avro_types(df: DataFrame) -> DataFrame:
    """Logical types back to the integers Avro stores: epoch days and epoch microseconds."""
    def raw(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return F.unix_date(column).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(column.cast("timestamp")).alias(f.name)
        return column
    return df.select(*[raw(f) for f in df.schema.fields])


# ---------------------------------------------------------------- load

def detect_schema(spark: SparkSession, paths: list[str], fmt: str, csv: CsvOptions,
                  sampling_ratio: float = 1.0) -> T.StructType:
    reader = spark.read.option("samplingRatio", sampling_ratio)
    if fmt == "json":
        return reader.json(paths).schema
    return (reader.options(**csv.reader()).option("inferSchema", True)
                  .option("header", csv.skip_leading_rows > 0).csv(paths).schema)


def load(spark: SparkSession, paths: str | list[str], fmt: str, schema: dict | T.StructType | None = None,
         *, csv: CsvOptions = CsvOptions(), autodetect: bool = False,
         ignore_unknown_values: bool = False, max_bad_records: int = 0,
         use_logical_types: bool = True, fail_on_empty: bool = True,
         sampling_ratio: float = 1.0) -> LoadResult:
    """Read files into rows; raise when more than ``max_bad_records`` records are bad."""
    began = time.monotonic()
    fmt = fmt.lower()
    uris = check_uris(paths)
    size = input_files(spark, uris).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    declared = to_struct_type(schema) if isinstance(schema, dict) else schema
    if size["bytes"] == 0:
        if fail_on_empty:
            raise EmptyInputError(f"no bytes in {uris}")
        empty = spark.createDataFrame([], declared or T.StructType([]))
        return LoadResult(empty, empty, _stats(spark, 0, 0, 0, size), empty.schema)
    if fmt in ("csv", "json"):
        if declared is None:
            if not autodetect:
                raise ValueError("give a schema or ask for autodetect")
            declared = detect_schema(spark, uris, fmt, csv, sampling_ratio)
        flagged = (read_csv_flagged(spark, uris, declared, csv, ignore_unknown_values)
                   if fmt == "csv" else
                   read_json_flagged(spark, uris, declared, ignore_unknown_values))
        path = scratch_dir(spark, "load")
        flagged.write.partitionBy("_bad").parquet(path)
        staged = spark.read.schema(
            T.StructType([*relaxed(declared).fields, T.StructField(RAW, T.StringType()),
                          T.StructField("_bad", T.BooleanType())])).parquet(path)
        good = staged.where(~F.col("_bad")).drop("_bad", RAW)
        bad = staged.where("_bad").select(RAW)
        # two lines; the flag is a folder name, so this reads file footers only
        counted = {r["_bad"]: r["count"] for r in staged.groupBy("_bad").count().collect()}
        n_good, n_bad = counted.get(False, 0), counted.get(True, 0)
        if n_bad > max_bad_records:
            raise BadRecordsError(n_bad, max_bad_records)
        out = input_files(spark, [f"{path}/_bad=false"]) if n_good else None
    else:
        if fmt == "avro":
            good = read_avro(spark, uris, use_logical_types)
        elif fmt in ("parquet", "orc"):
            reader = spark.read.schema(relaxed(declared)) if declared is not None else spark.read
            good = reader.format(fmt).load(uris)
        else:
            raise ValueError(f"unknown format {fmt}")
        n_bad = 0
        if declared is None:
            declared = good.schema
        elif any(not f.nullable for f in declared.fields):
            n_bad = good.where(missing_required(declared)).count()
            if n_bad > max_bad_records:
                raise BadRecordsError(n_bad, max_bad_records)
            good = good.where(~missing_required(declared))
        bad = good.limit(0)
        n_good = good.count()
        out = input_files(spark, uris)
    out_bytes = out.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] if out is not None else 0
    stats = _stats(spark, n_good, out_bytes, n_bad, size)
    return LoadResult(good, bad, stats, declared, int((time.monotonic() - began) * 1000))


def _stats(spark: SparkSession, rows: int, out_bytes: int, bad: int, size) -> DataFrame:
    return spark.createDataFrame(
        [(rows, out_bytes, bad, size["files"], size["bytes"])],
        "output_rows bigint, output_bytes bigint, bad_records bigint, input_files bigint, input_bytes bigint")


def load_into(table, paths: str | list[str], fmt: str, schema: dict | T.StructType, *,
              csv: CsvOptions = CsvOptions(), ignore_unknown_values: bool = False,
              max_bad_records: int = 0, derive: dict[str, Column] | None = None) -> dict[str, int]:
    """Load CSV or JSON text into a versioned table, writing the rows only once.

    Good rows are parsed straight into folders of the table, bad ones beside them. The good
    folders become visible with the next version, and only if the budget holds. ``derive``
    adds columns, such as the table's partition id.
    """
    spark = table.spark
    uris = check_uris(paths)
    declared = to_struct_type(schema) if isinstance(schema, dict) else schema
    flagged = (read_csv_flagged(spark, uris, declared, csv, ignore_unknown_values) if fmt == "csv"
               else read_json_flagged(spark, uris, declared, ignore_unknown_values))
    for name, column in (derive or {}).items():
        flagged = flagged.withColumn(name, column)
    good, bad = table.stage_flagged(flagged, "_bad")
    n_bad = table.count_rows(bad)
    if n_bad > max_bad_records:
        raise BadRecordsError(n_bad, max_bad_records)
    if good:
        table.attach(good)
    return {"output_rows": table.count_rows(good), "bad_records": n_bad}


# ---------------------------------------------------------------- external tables

def create_external_table(spark: SparkSession, name: str, uris: str | list[str], fmt: str,
                          schema: dict | T.StructType | None = None, *, csv: CsvOptions = CsvOptions(),
                          compression: str | None = None, ignore_unknown_values: bool = True,
                          drop_bad_records: bool = False, max_bad_records: int | None = None,
                          autodetect: bool = False, sampling_ratio: float = 1.0) -> None:
    """A table over files that stay where they are.

    With a bad-record or unknown-value policy, or with several locations, the name becomes a
    session view whose plan applies the policy; otherwise it is a catalog table. ``max_bad_records`` is the
    budget of each read: up to it, bad records are left out, beyond it, the read fails. It counts them over all files at the
    time of the read. ``autodetect`` takes the schema from the files as they are now.
    """
    paths = check_uris(uris)
    fmt = fmt.lower()
    declared = to_struct_type(schema) if isinstance(schema, dict) else schema
    if declared is None:
        if not autodetect:
            raise ValueError("give a schema or ask for autodetect")
        declared = (detect_schema(spark, paths, fmt, csv, sampling_ratio) if fmt in ("csv", "json")
                    else spark.read.format(fmt).load(paths).schema)
    policy = drop_bad_records or not ignore_unknown_values or max_bad_records is not None
    if fmt in ("csv", "json") and policy:
        flagged = (read_csv_flagged(spark, paths, declared, csv, ignore_unknown_values)
                   if fmt == "csv" else read_json_flagged(spark, paths, declared, ignore_unknown_values))
        if max_bad_records is not None:
            # one figure of a scan of its own; bad rows are still there when it is looked at, so none can hide it
            n_bad = flagged.agg(F.count_if("_bad")).scalar()
            beyond = F.raise_error(F.concat(F.lit(f"more than {max_bad_records} bad records: "), n_bad.cast("string")))
            rows = flagged.where(F.when(n_bad <= max_bad_records, ~F.col("_bad")).otherwise(beyond.cast("boolean")))
        elif drop_bad_records:
            rows = flagged.where(~F.col("_bad"))
        else:
            refuse = F.raise_error(F.concat(F.lit("bad record: "), F.coalesce(RAW, F.lit(""))))
            rows = flagged.where(F.when(~F.col("_bad"), True).otherwise(refuse.cast("boolean")))
        rows.drop("_bad", RAW).createOrReplaceTempView(name)
        return
    options = csv.reader() if fmt == "csv" else {}
    if compression:
        options["compression"] = compression
    if len(paths) > 1 or "*" in paths[0]:
        (spark.read.format(fmt).options(**options).schema(relaxed(declared)).load(paths)
              .createOrReplaceTempView(name))
        return
    clause = ", ".join(f"'{k}' = '{v}'" for k, v in options.items())
    spark.sql(f"CREATE TABLE {name} ({relaxed(declared).toDDL()}) USING {fmt} "
              + (f"OPTIONS ({clause}) " if clause else "") + f"LOCATION '{paths[0]}'")
