"""Declared schemas: ``{"fields": [{name, type, mode, description, fields}]}``."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# Warehouse type names and the Spark type that holds each one.
SPARK_TYPES = {
    "BOOL": T.BooleanType(), "BOOLEAN": T.BooleanType(),
    "INT64": T.LongType(), "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(), "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9), "BIGNUMERIC": T.DecimalType(38, 18),
    "STRING": T.StringType(), "BYTES": T.BinaryType(),
    "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(), "TIMESTAMP": T.TimestampType(),
    "TIME": T.StringType(), "INTERVAL": T.StringType(),
    "GEOGRAPHY": T.StringType(), "JSON": T.StringType(), "RANGE": T.StringType(),
}
# Column modes.
MODES = ("NULLABLE", "REQUIRED", "REPEATED")


def to_struct_type(schema: dict) -> T.StructType:
    """Turn a declared schema into a StructType.

    The declared type name stays in the field metadata (``declared``), so text columns
    that stand for TIME, JSON, GEOGRAPHY, INTERVAL or RANGE can be told apart later.
    """
    if not schema or schema.get("fields") is None:
        raise ValueError("a declared schema needs a 'fields' list")
    return T.StructType([_field(f) for f in schema["fields"]])


def _field(spec: dict) -> T.StructField:
    declared = spec["type"].upper()
    mode = (spec.get("mode") or "NULLABLE").upper()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode} for field {spec['name']}")
    if declared in ("RECORD", "STRUCT"):
        data_type: T.DataType = to_struct_type(spec)
    elif declared in SPARK_TYPES:
        data_type = SPARK_TYPES[declared]
    else:
        raise ValueError(f"unknown type {declared} for field {spec['name']}")
    metadata = {"declared": declared, "mode": mode}
    if spec.get("description"):
        metadata["comment"] = spec["description"]
    if mode == "REPEATED":
        data_type = T.ArrayType(data_type, containsNull=False)
    return T.StructField(spec["name"], data_type, mode != "REQUIRED", metadata)


def missing_required(schema: T.StructType, parent: Column | None = None) -> Column:
    """True when a REQUIRED field is null. Readers do not enforce ``nullable=False``."""
    broken = F.lit(False)
    for field in schema.fields:
        column = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        if not field.nullable:
            broken = broken | column.isNull()
        if isinstance(field.dataType, T.StructType):
            inner = missing_required(field.dataType, column)
            broken = broken | (column.isNotNull() & inner)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(
                field.dataType.elementType, T.StructType):
            element = field.dataType.elementType
            broken = broken | F.coalesce(
                F.exists(column, lambda e: missing_required(element, e)), F.lit(False))
    return broken


def relaxed(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable: what a reader needs to hand bad rows back."""
    def loosen(data_type: T.DataType) -> T.DataType:
        if isinstance(data_type, T.StructType):
            return relaxed(data_type)
        if isinstance(data_type, T.ArrayType):
            return T.ArrayType(loosen(data_type.elementType), True)
        return data_type
    return T.StructType([
        T.StructField(f.name, loosen(f.dataType), True, f.metadata) for f in schema.fields])


def required_paths(schema: T.StructType, parent: str = "") -> list[str]:
    """Names of REQUIRED fields at any depth: ``s.a`` in a struct, ``items[].a`` in the structs of an array."""
    found = []
    for field in schema.fields:
        path = f"{parent}{field.name}"
        found += [] if field.nullable else [path]
        kind, mark = field.dataType, "."
        if isinstance(kind, T.ArrayType):
            kind, mark = kind.elementType, "[]."
        if isinstance(kind, T.StructType):
            found += required_paths(kind, path + mark)
    return found


def lacks(path: str, of: Column | None = None) -> Column:
    """True where a field of ``required_paths`` is null; a struct that is null itself lacks nothing."""
    name, _, rest = path.partition(".")
    column = F.col(f"`{name.removesuffix('[]')}`") if of is None else of.getField(name.removesuffix("[]"))
    if not rest:
        return column.isNull()
    if name.endswith("[]"):
        return F.coalesce(F.exists(column, lambda e: e.isNotNull() & lacks(rest, e)), F.lit(False))
    return column.isNotNull() & lacks(rest, column)


def merged(old: T.DataType, new: T.DataType, path: str, added: list[str]) -> T.DataType:
    """``old`` with the fields that only ``new`` has, at any depth, behind its own; their names go to ``added``."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        theirs = {f.name: f for f in new.fields}
        fields = [T.StructField(f.name, merged(f.dataType, theirs[f.name].dataType, f"{path}.{f.name}", added) if f.name in theirs else f.dataType,
                                True, f.metadata) for f in old.fields]
        more = [f for f in new.fields if f.name not in old.fieldNames()]
        added += [f"{path}.{f.name}" for f in more]
        return T.StructType([*fields, *relaxed(T.StructType(more)).fields])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged(old.elementType, new.elementType, path, added), True)
    return old


def reshaped(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the fields and order of ``want``; missing fields are null."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = [(reshaped(column.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in want.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda e: reshaped(e, have.elementType, want.elementType))
    return column.cast(want)
