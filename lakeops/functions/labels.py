"""Label text and cost columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longest label, and the price of one tebibyte read.
LABEL_LENGTH = 63
USD_PER_TEBIBYTE = 5
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]


def clean_label(column: Column) -> Column:
    """Dots become underscores, lower case, at most 63 characters."""
    return F.substring(F.lower(F.replace(column, F.lit("."), F.lit("_"))), 1, LABEL_LENGTH)


def cost_usd(size: Column) -> Column:
    return size / F.lit(float(1024 ** 4)) * F.lit(USD_PER_TEBIBYTE)


def readable_size(size: Column) -> Column:
    """Bytes scaled to the largest fitting unit; two decimals above plain bytes."""
    text = F.concat(size.cast("bigint").cast("string"), F.lit(" B"))
    for power, unit in enumerate(SIZE_UNITS):
        if power:
            scaled = F.round(size / F.lit(float(1024 ** power)), 2).cast("decimal(38,2)")
            text = F.when(size >= F.lit(1024 ** power),
                          F.concat(scaled.cast("string"), F.lit(f" {unit}"))).otherwise(text)
    return text
