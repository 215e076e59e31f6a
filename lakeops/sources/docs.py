"""Document collections: ``doc_id`` and a JSON payload in ``data``."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.skew import number_rows

# Comparison operators of a document filter.
OPERATORS = {
    "EQUAL_TO": lambda field, value: field == value,
    "NOT_EQUAL_TO": lambda field, value: field != value,
    "LESS_THAN": lambda field, value: field < value,
    "LESS_THAN_OR_EQUAL_TO": lambda field, value: field <= value,
    "GREATER_THAN": lambda field, value: field > value,
    "GREATER_THAN_OR_EQUAL_TO": lambda field, value: field >= value,
}

#: End of the last page that is read through the first rows of each task; pages beyond are found by row numbers.
MAX_PAGE_END = 100_000


def doc_get(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.where(F.col("doc_id") == doc_id)


def doc_scan(docs: DataFrame) -> DataFrame:
    return docs.withColumn("data", F.try_parse_json("data"))


def doc_field(name: str, data_type: str = "string", payload: str = "data") -> Column:
    """A payload field; ``name`` may be a dotted path. Missing fields are null."""
    path = "".join(f"[{json.dumps(p)}]" for p in name.split("."))
    column = F.try_variant_get(F.try_parse_json(payload), f"${path}", data_type)
    return column


def doc_query(docs: DataFrame, filters: list[tuple] = (), order_by: str | None = None,
              direction: str = "ASCENDING", offset: int = 0, limit: int | None = None,
              types: dict[str, str] | None = None) -> DataFrame:
    """AND of ``(field, operator, value)``, then order, then offset, then limit.

    A missing field matches nothing but ``EQUAL_TO None``. With an order, documents that
    lack the field are left out and ties fall back to the id. ``types`` names the type of
    fields that are not text. A column of that name beside the payload wins over the
    payload, so hot fields can be promoted to columns and reach the file statistics.
    """
    def field(name: str) -> Column:
        kind = (types or {}).get(name, "string")
        return F.col(name).cast(kind) if name in docs.columns else doc_field(name, kind)

    found = docs
    for name, operator, value in filters:
        if operator not in OPERATORS:
            raise ValueError(f"unknown operator {operator}")
        if value is None:
            if operator not in ("EQUAL_TO", "NOT_EQUAL_TO"):
                raise ValueError(f"{operator} needs a value")
            found = found.where(field(name).isNull() if operator == "EQUAL_TO"
                                else field(name).isNotNull())
        else:
            found = found.where(OPERATORS[operator](field(name), F.lit(value)))
    if order_by is not None:
        up = direction.upper() == "ASCENDING"
        key = field(order_by)
        found = found.where(key.isNotNull()).orderBy(
            key.asc() if up else key.desc(), F.asc("doc_id") if up else F.desc("doc_id"))
    elif offset or limit is not None:
        found = found.orderBy("doc_id")
    if not offset:
        return found if limit is None else found.limit(limit)
    if limit is not None and offset + limit <= MAX_PAGE_END:
        return found.offset(offset).limit(limit)
    # a page far behind, or all that follows: rows get numbers in their tasks, none of which holds the whole
    order = [key.alias("_key"), F.col("doc_id").alias("_id")] if order_by is not None else [F.col("doc_id").alias("_id")]
    down = order_by is not None and not up
    numbered = number_rows(found.select(F.struct(*[F.col(f"`{c}`") for c in found.columns]).alias("_row"), *order),
                           [F.desc(c) if down else F.asc(c) for c in (["_key", "_id"] if order_by is not None else ["_id"])], "_n")
    last = F.lit(True) if limit is None else F.col("_n") < offset + limit
    return numbered.where((F.col("_n") >= offset) & last).orderBy("_n").select("_row.*")
