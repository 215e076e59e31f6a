"""Partition ids: how a value maps to an id, and how an id maps back to a moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id pattern per granularity, and the digits that complete it to a second.
ID_PATTERNS = {"HOUR": "yyyyMMddHH", "DAY": "yyyyMMdd", "MONTH": "yyyyMM", "YEAR": "yyyy"}
ID_PADDING = {"HOUR": "0000", "DAY": "000000", "MONTH": "01000000", "YEAR": "0101000000"}
BOUND_PATTERN = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][XXX]"
# Ids of rows without a partition value, or outside the declared range.
NULL_ID = "__NULL__"
UNPARTITIONED_ID = "__UNPARTITIONED__"


def check_granularity(granularity: str) -> str:
    name = granularity.upper()
    if name not in ID_PATTERNS and name != "RANGE":
        raise ValueError(f"unknown partition type {granularity}")
    return name


def time_id(column: Column, granularity: str = "DAY") -> Column:
    pattern = ID_PATTERNS[check_granularity(granularity)]
    return F.coalesce(F.date_format(column, pattern), F.lit(NULL_ID))


def range_id(column: Column, start: int, end: int, interval: int) -> Column:
    """Half-open ``[start, end)`` buckets named by their lower edge."""
    if interval <= 0 or end <= start:
        raise ValueError("a range partition needs end > start and a positive interval")
    edge = F.floor((column - F.lit(start)) / F.lit(interval)) * interval + start
    inside = (column >= start) & (column < end)
    return (F.when(column.isNull(), NULL_ID)
             .when(inside, edge.cast("bigint").cast("string"))
             .otherwise(UNPARTITIONED_ID))


def within(partition_id: Column, granularity: str, low: str, high: str) -> Column:
    """True for ids whose start lies in the inclusive range; marker ids never match.

    The bounds are wall-clock text; an offset in them is read but does not shift the time.
    """
    name = check_granularity(granularity)
    marker = partition_id.isin(NULL_ID, UNPARTITIONED_ID)
    if name == "RANGE":
        value = partition_id.try_cast("bigint")
        return ~marker & value.between(int(low), int(high))
    moment = F.try_to_timestamp(
        F.concat(partition_id, F.lit(ID_PADDING[name])), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    return ~marker & moment.between(bound(low), bound(high))


def bound(text: str) -> Column:
    """A range bound as a wall-clock timestamp."""
    return F.to_timestamp_ntz(F.lit(text), F.lit(BOUND_PATTERN))
