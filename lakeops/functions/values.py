"""Cell conversions: the uniform row model (normalise) and the storage row form (encode).

Both are recursive Column builders over the schema, so Catalyst sees plain expressions.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

# Accepted text forms.
POINT_TEXT = r"^\s*POINT\s*\(\s*([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s+([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s*\)\s*$"
RANGE_TEXT = r"^\s*\[\s*([^,]*?)\s*,\s*([^)]*?)\s*\)\s*$"


def _declared(field: T.StructField) -> str:
    return (field.metadata or {}).get("declared", "")


def _walk(column: Column, data_type: T.DataType, declared: str,
          leaf: Callable[[Column, T.DataType, str], Column]) -> Column:
    if isinstance(data_type, T.StructType):
        inner = [
            _walk(column.getField(f.name), f.dataType, _declared(f), leaf).alias(f.name)
            for f in data_type.fields]
        return F.when(column.isNotNull(), F.struct(*inner))
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda e: _walk(e, data_type.elementType, declared, leaf))
    if isinstance(data_type, T.MapType):
        return F.transform_values(
            column, lambda _, v: _walk(v, data_type.valueType, declared, leaf))
    return leaf(column, data_type, declared)


def _select(df: DataFrame, leaf: Callable[[Column, T.DataType, str], Column]) -> DataFrame:
    return df.select(*[
        _walk(F.col(f"`{f.name}`"), f.dataType, _declared(f), leaf).alias(f.name)
        for f in df.schema.fields])


def datetime_text(column: Column) -> Column:
    """ISO text with a closing Z; the fraction appears only when there is one."""
    text = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.replace(text, F.lit(".000000Z"), F.lit("Z"))


def point(column: Column) -> Column:
    """``POINT(lon lat)`` text to ``[lon, lat]``; any other text is an error."""
    parsed = F.array(
        F.regexp_extract(column, POINT_TEXT, 1).try_cast("double"),
        F.regexp_extract(column, POINT_TEXT, 2).try_cast("double"))
    return (F.when(column.isNull(), F.lit(None))
             .when(column.rlike(POINT_TEXT), parsed)
             .otherwise(F.raise_error(F.concat(F.lit("not a POINT: "), column)).cast("array<double>")))


def range_bounds(column: Column) -> Column:
    """``[start, end)`` text to a struct of timestamps; UNBOUNDED becomes null, any other text is an
    error. Bounds without a zone are UTC, and a date is the midnight that it begins with."""
    wrong = F.raise_error(F.concat(F.lit("not a RANGE: "), column))

    def bound(group: int) -> Column:
        text = F.replace(F.trim(F.regexp_extract(column, RANGE_TEXT, group)), F.lit("T"), F.lit(" "))
        at = F.coalesce(*[F.try_to_timestamp(F.concat(text, F.lit(rest)), F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX"))
                          for rest in ("", "Z", " 00:00:00Z")])
        return F.when(~F.upper(text).isin("UNBOUNDED", "NULL", ""), F.coalesce(at, wrong.cast("timestamp")))
    return (F.when(column.isNull(), F.lit(None))
             .when(column.rlike(RANGE_TEXT), F.struct(bound(1).alias("start"), bound(2).alias("end")))
             .otherwise(wrong.cast("struct<start:timestamp,end:timestamp>")))


def json_value(column: Column) -> Column:
    """The value of JSON text; null stays null, and text that is not JSON is a string value."""
    as_text = F.variant_get(F.parse_json(F.to_json(F.array(column))), "$[0]", "variant")
    return F.when(column.isNotNull(), F.coalesce(F.try_parse_json(column), as_text))


def interval_text(column: Column, data_type: T.DataType) -> Column:
    """``years-months days hours:minutes:seconds`` with the sign on each part."""
    months = isinstance(data_type, T.YearMonthIntervalType)
    full = column.cast("interval year to month" if months else "interval day to second")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), full)

    def signed(negative: Column, *texts: Column) -> Column:
        return F.concat(F.when(negative, "-").otherwise(""), *texts)

    if months:
        return F.concat(
            signed((part("YEAR") < 0) | (part("MONTH") < 0),
                   F.abs(part("YEAR")).cast("string"), F.lit("-"),
                   F.abs(part("MONTH")).cast("string")),
            F.lit(" 0 0:0:0"))
    seconds = F.regexp_replace(F.abs(part("SECOND")).cast("string"), r"\.?0+$", "")
    return F.concat(
        F.lit("0-0 "), part("DAY").cast("string"), F.lit(" "),
        signed((part("HOUR") < 0) | (part("MINUTE") < 0) | (part("SECOND") < 0),
               F.abs(part("HOUR")).cast("string"), F.lit(":"),
               F.abs(part("MINUTE")).cast("string"), F.lit(":"), seconds))


def normalise(df: DataFrame, json_as: str = "variant") -> DataFrame:
    """Uniform row model: datetime as ISO text, geography as a pair, JSON as a value."""
    def leaf(column: Column, data_type: T.DataType, declared: str) -> Column:
        if isinstance(data_type, T.TimestampNTZType):
            return datetime_text(column)
        if isinstance(data_type, (T.YearMonthIntervalType, T.DayTimeIntervalType)):
            return interval_text(column, data_type)
        if isinstance(data_type, T.VariantType):
            return column if json_as == "variant" else F.to_json(column)
        if declared == "GEOGRAPHY":
            return point(column)
        if declared == "RANGE":
            return range_bounds(column)
        if declared == "JSON":
            value = json_value(column)
            return value if json_as == "variant" else F.to_json(value)
        return column
    return _select(df, leaf)


def _bits(*parts: tuple[Column, int]) -> Column:
    packed = F.lit(0).cast("bigint")
    for part, shift in parts:
        packed = packed.bitwiseOR(F.shiftleft(part.cast("bigint"), shift))
    return packed


def _micros_of_second(column: Column) -> Column:
    return F.date_format(column, "SSSSSS").cast("bigint")


def packed_datetime(column: Column) -> Column:
    """Civil datetime in 64 bits: year, month, day, hour, minute, second, 20 bits of µs."""
    return F.when(column.isNotNull(), _bits(
        (F.year(column), 46), (F.month(column), 42), (F.dayofmonth(column), 37),
        (F.hour(column), 32), (F.minute(column), 26), (F.second(column), 20),
        (_micros_of_second(column), 0)))


def packed_time(column: Column) -> Column:
    """``HH:mm:ss[.ffffff]`` text in 64 bits: hour, minute, second, 20 bits of µs."""
    moment = F.to_timestamp_ntz(F.concat(F.lit("1970-01-01 "), column))
    return F.when(column.isNotNull(), _bits(
        (F.hour(moment), 32), (F.minute(moment), 26), (F.second(moment), 20),
        (_micros_of_second(moment), 0)))


def encode_rows(df: DataFrame, compat_millis: bool = False) -> DataFrame:
    """Storage row form: timestamps as epoch µs, dates as epoch days, civil times packed.

    ``compat_millis`` cuts timestamps to whole milliseconds.
    """
    def leaf(column: Column, data_type: T.DataType, declared: str) -> Column:
        if isinstance(data_type, T.TimestampType):
            if compat_millis:
                return F.unix_millis(column) * F.lit(1000)
            return F.unix_micros(column)
        if isinstance(data_type, T.TimestampNTZType):
            return packed_datetime(column)
        if isinstance(data_type, T.DateType):
            return F.unix_date(column)
        if declared == "TIME":
            return packed_time(column)
        return column
    return _select(df, leaf)
