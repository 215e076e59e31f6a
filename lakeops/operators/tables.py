"""Catalog tables: dispositions, schema updates, clustering, definitions, metadata, copies."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.schema import lacks, merged, relaxed, required_paths, reshaped, to_struct_type
from lakeops.operators.partitions import PARTITION, drop_partitions, list_partitions
from lakeops.operators.skew import cluster_evenly, rank_evenly
from lakeops.session import materialise

# Write and create dispositions, and allowed schema updates.
WRITES = ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY")
CREATES = ("CREATE_IF_NEEDED", "CREATE_NEVER")
SCHEMA_UPDATES = ("ALLOW_FIELD_ADDITION", "ALLOW_FIELD_RELAXATION")
# Names of the table properties this module reads and writes.
REQUIRED, EXPIRES, PARTITION_TTL, CLUSTERING = (
    "lakeops.required", "lakeops.expires_ms", "lakeops.partition_ttl_ms", "lakeops.clustering")
# Name of the database property with the lifetime of new tables.
DEFAULT_TTL = "lakeops.default_table_ttl_ms"


def check_table_name(name: str) -> list[str]:
    parts = name.split(".")
    if len(parts) not in (2, 3) or not all(parts):
        raise ValueError(f"a table name has 2 or 3 parts: {name}")
    return parts


def table_property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).head(1)
    return rows[0]["value"] if rows else None


def write_table(df: DataFrame, name: str, *, write: str = "WRITE_APPEND",
                create: str = "CREATE_IF_NEEDED", partitioned: bool = False,
                cluster_by: list[str] = (), schema_update: list[str] = (), interleave: bool = False) -> None:
    """Write rows to a catalog table.

    Partitioned output is rebalanced by partition id: the adaptive planner splits ids that
    hold much data and merges small ones, so a single large partition is written by many
    tasks. Clustered output is range-partitioned and sorted instead, by the columns in their order, or, with
    ``interleave``, so that a filter on any one of them alone reads a small part of the files.
    """
    spark = df.sparkSession
    check_table_name(name)
    if write not in WRITES or create not in CREATES:
        raise ValueError(f"write in {WRITES}, create in {CREATES}")
    if set(schema_update) - set(SCHEMA_UPDATES):
        raise ValueError(f"schema updates are {SCHEMA_UPDATES}")
    if schema_update and write == "WRITE_EMPTY":
        raise ValueError("schema updates need append or truncate")
    exists = spark.catalog.tableExists(name)
    if not exists and create == "CREATE_NEVER":
        raise ValueError(f"{name} does not exist")
    if exists and write == "WRITE_EMPTY" and spark.table(name).head(1):
        raise ValueError(f"{name} already holds rows")
    if exists:
        df = _fit_schema(spark, df, name, schema_update)
        declared = table_property(spark, name, CLUSTERING)
        cluster_by = list(cluster_by) or (declared.split(",") if declared else [])
        partitioned = partitioned or PARTITION in spark.table(name).columns
    if exists and write == "WRITE_TRUNCATE":
        # written down first: a failing row leaves the table as it was, and rows may come from it
        df = materialise(df, "truncate")
    if cluster_by:
        before = [PARTITION] if partitioned else []
        df = cluster_evenly(df, list(cluster_by), before) if interleave else rank_evenly(df, [*before, *cluster_by])
    elif partitioned:
        df = df.hint("rebalance", PARTITION)
    if not exists:
        writer = df.write.partitionBy(PARTITION) if partitioned else df.write
        writer.format("parquet").saveAsTable(name)
        _limit_lifetime(spark, name)
    else:
        (df.select(*spark.table(name).columns).write
           .option("partitionOverwriteMode", "static")
           .insertInto(name, overwrite=write == "WRITE_TRUNCATE"))
    if cluster_by:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{CLUSTERING}' = '{','.join(cluster_by)}')")


def set_default_lifetime(spark: SparkSession, database: str, table_ttl_ms: int | None) -> None:
    """How long tables live that are made in the database from now on, unless they name their own expiry; None for ever."""
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{DEFAULT_TTL}' = '{table_ttl_ms or ''}')")


def _limit_lifetime(spark: SparkSession, name: str, now_ms: int | None = None) -> None:
    """Give a new table the default lifetime of its database."""
    database = name.rsplit(".", 1)[0]
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()}
    found = re.search(rf"\({re.escape(DEFAULT_TTL)},\s*(\d+)\)", described.get("Properties", ""))
    if found and not table_property(spark, name, EXPIRES):
        now_ms = int(time.time() * 1000) if now_ms is None else now_ms
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{EXPIRES}' = '{now_ms + int(found[1])}')")


def _fit_schema(spark: SparkSession, df: DataFrame, name: str, schema_update) -> DataFrame:
    """Checks the rows against the table; adds or relaxes fields where that is allowed."""
    table = spark.table(name)
    added = [f for f in df.schema.fields if f.name not in table.columns]
    absent = [f for f in table.schema.fields if f.name not in df.columns]
    required = [path for path in (table_property(spark, name, REQUIRED) or "").split(",") if path]
    if added:
        if "ALLOW_FIELD_ADDITION" not in schema_update:
            raise ValueError(f"{name} has no fields {[f.name for f in added]}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    for f in absent:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    df = _fit_nested(spark, df, name, table.schema, schema_update)
    if not required:
        return df
    if "ALLOW_FIELD_RELAXATION" in schema_update:
        missing = df.agg(*[F.count_if(lacks(path)).alias(f"_{i}") for i, path in enumerate(required)]).first()
        left = [path for i, path in enumerate(required) if not missing[f"_{i}"]]
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{REQUIRED}' = '{','.join(left)}')" if left
                  else f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{REQUIRED}')")
        return df
    good = F.lit(True)
    for path in required:
        good = F.when(lacks(path), F.raise_error(F.lit(f"{path} is required")).cast("boolean")).otherwise(good)
    return df.where(good)


def _fit_nested(spark: SparkSession, df: DataFrame, name: str, schema: T.StructType, schema_update) -> DataFrame:
    """Rows in the table's nested shape; fields that only the rows have are added where that is allowed.

    Files stay as they are: a reader finds null where an older file lacks a field.
    """
    added: list[str] = []
    kinds = {f.name: merged(f.dataType, df.schema[f.name].dataType, f.name, added) for f in schema.fields if _nested(f.dataType)}
    if added and "ALLOW_FIELD_ADDITION" not in schema_update:
        raise ValueError(f"{name} has no fields {added}")
    if added:
        parts = [f.name for f in spark.table(name).schema.fields if f.name == PARTITION]
        wanted = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType), True, f.metadata)
                               for f in spark.table(name).schema.fields if f.name not in parts])
        # SQL can add nested fields to newer catalogs only; this changes the definition alone
        state = spark._jsparkSession.sessionState()
        state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(name),
                                             spark._jvm.org.apache.spark.sql.types.DataType.fromJson(wanted.json()))
        spark.catalog.refreshTable(name)
    return df.select(*[reshaped(F.col(f"`{f.name}`"), f.dataType, kinds[f.name]).alias(f.name) if f.name in kinds else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) or isinstance(kind, T.ArrayType) and _nested(kind.elementType)


def create_table(spark: SparkSession, name: str, definition: dict) -> None:
    """A table from ``{schema, partitioned, clustering, labels, expires_ms,
    partition_ttl_ms, description}``."""
    check_table_name(name)
    schema = to_struct_type(definition["schema"])
    columns = relaxed(schema).toDDL()
    properties = {f"label.{k}": v for k, v in definition.get("labels", {}).items()}
    required = required_paths(schema)
    for key, value in ((REQUIRED, ",".join(required)), (EXPIRES, definition.get("expires_ms")),
                       (PARTITION_TTL, definition.get("partition_ttl_ms")),
                       (CLUSTERING, ",".join(definition.get("clustering", [])))):
        if value:
            properties[key] = str(value)
    statement = f"CREATE TABLE {name} ({columns}"
    statement += f", {PARTITION} STRING) USING parquet PARTITIONED BY ({PARTITION})" \
        if definition.get("partitioned") else ") USING parquet"
    if definition.get("description"):
        statement += " COMMENT '" + definition["description"].replace("'", "\\'") + "'"
    if properties:
        statement += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(statement)
    _limit_lifetime(spark, name)


def table_metadata(spark: SparkSession, name: str, if_missing: str = "ERROR") -> DataFrame | None:
    """Kind, rows, bytes, partitioning, clustering, labels, expiry and columns of a table, as one row."""
    if not spark.catalog.tableExists(name):
        if if_missing == "SKIP":
            return None
        raise ValueError(f"{name} does not exist")
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    rows = size = modified = None
    if described.get("Type") != "VIEW":
        # no column is read: the figures come from the files' footers and their listing
        files = spark.table(name).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified")).groupBy("path", "size", "modified").count()
        rows, size, modified = files.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)),
                                         F.max(F.unix_millis("modified"))).first()
    columns = spark.table(name).dtypes
    properties = ({} if described.get("Type") == "VIEW" else
                  {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()})
    return spark.createDataFrame(
        [(name, described.get("Type"), rows, size, PARTITION in dict(columns),
          [f"{c} {t}" for c, t in columns], described.get("Comment"), described.get("Created Time"),
          properties[CLUSTERING].split(",") if properties.get(CLUSTERING) else [],
          {k[6:]: v for k, v in properties.items() if k.startswith("label.")},
          int(properties[EXPIRES]) if properties.get(EXPIRES) else None, modified)],
        "name string, kind string, num_rows bigint, num_bytes bigint, partitioned boolean, "
        "columns array<string>, description string, created string, clustering array<string>, "
        "labels map<string,string>, expires_ms bigint, modified_ms bigint")


def copy_tables(spark: SparkSession, sources: list[str], target: str, *,
                write: str = "WRITE_EMPTY", create: str = "CREATE_IF_NEEDED") -> None:
    """Copies one or several tables; ``table$id`` names a single partition."""
    frames = []
    for source in sources:
        table, _, partition = source.partition("$")
        rows = spark.table(table)
        frames.append(rows.where(F.col(PARTITION) == partition) if partition else rows)
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    write_table(union, target, write=write, create=create, partitioned=PARTITION in union.columns)


def expire(spark: SparkSession, database: str, now_ms: int | None = None,
           default_ttl_ms: int | None = None) -> dict[str, list[str]]:
    """Drops tables past their expiry and time partitions older than the table's limit."""
    from datetime import datetime, timezone

    from lakeops.functions.partition_ids import ID_PADDING, ID_PATTERNS
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    dropped: dict[str, list[str]] = {"tables": [], "partitions": []}
    by_width = {len(p): ID_PADDING[g] for g, p in ID_PATTERNS.items()}
    for table in spark.catalog.listTables(database):
        if table.isTemporary or table.tableType == "VIEW":
            continue
        name = f"{database}.{table.name}"
        expires = table_property(spark, name, EXPIRES)
        if expires and int(expires) <= now_ms:
            spark.sql(f"DROP TABLE {name}")
            dropped["tables"].append(name)
            continue
        ttl = table_property(spark, name, PARTITION_TTL) or default_ttl_ms
        if not ttl or PARTITION not in spark.table(name).columns:
            continue
        edge = datetime.fromtimestamp((now_ms - int(ttl)) / 1000, timezone.utc).strftime("%Y%m%d%H%M%S")
        padded = F.col(PARTITION)
        full = F.lit(None).cast("string")
        for width, padding in by_width.items():
            full = F.when(F.length(padded) == width, F.concat(padded, F.lit(padding))).otherwise(full)
        old = list_partitions(spark, name).where(padded.rlike("^[0-9]+$") & (full < edge))
        chosen = sorted(r[0] for r in old.collect())
        drop_partitions(spark, name, chosen)
        dropped["partitions"] += [f"{name}${c}" for c in chosen]
    return dropped
