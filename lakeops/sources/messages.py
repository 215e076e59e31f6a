"""Messages: ``{data, attributes, message_id, ordering_key}`` and their payload forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

# Payload forms.
SERDES = ("STRING", "JSON")


def check_serde(serde: str) -> str:
    if serde.upper() not in SERDES:
        raise ValueError(f"serde is one of {SERDES}")
    return serde.upper()


def encode_payload(column: Column, data_type: T.DataType, serde: str = "STRING") -> Column:
    """Text and bytes go verbatim in either form; other values are text or JSON."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return column.cast("binary")
    if check_serde(serde) == "STRING" and not isinstance(
            data_type, (T.StructType, T.ArrayType, T.MapType)):
        return column.cast("string").cast("binary")
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column).cast("binary")
    # a bare number or flag is its own JSON text
    return column.cast("string").cast("binary")


def decode_payload(column: Column, serde: str = "STRING") -> Column:
    """STRING decodes UTF-8; JSON parses to a variant and fails on anything else."""
    text = F.decode(column, "UTF-8")
    return text if check_serde(serde) == "STRING" else F.parse_json(text)


def decode(messages: DataFrame, serde: str = "STRING") -> DataFrame:
    return messages.withColumn("data", decode_payload(F.col("data"), serde))
