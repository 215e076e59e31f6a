"""Writes and deletes on wide-column cells (see ``lakeops.sources.widecol`` for the form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.versioned import Delete, Insert, Merge, VersionedTable
from lakeops.session import materialise

_COLUMN = ["row_key", "family", "qualifier"]


def mutation_cells(mutations: DataFrame, default_family: str | None, now_micros: int
                   ) -> tuple[DataFrame, DataFrame]:
    """Splits ``row_key, family, cells map, delete_cells array, seq`` into sets and deletes."""
    family = F.coalesce("family", F.lit(default_family))
    family = F.when(family.isNotNull(), family).otherwise(F.raise_error(
        F.concat(F.lit("no column family for row "), F.col("row_key"))).cast("string"))
    rows = mutations.withColumn("family", family)
    sets = rows.select("row_key", "family", F.explode("cells").alias("qualifier", "value"),
                       F.lit(now_micros).cast("bigint").alias("timestamp"), "seq")
    deletes = (rows.select("row_key", "family", F.explode("delete_cells").alias("qualifier"), "seq")
                   .groupBy(*_COLUMN).agg(F.max("seq").alias("_deleted_at")))
    return sets, deletes


def _written_cells(sets: DataFrame, deletes: DataFrame) -> DataFrame:
    """The cells that a bulk write leaves of its own."""
    last = (sets.groupBy(*_COLUMN, "timestamp")
                .agg(F.max_by("value", "seq").alias("value"), F.max("seq").alias("seq")))
    return (last.join(deletes, _COLUMN, "left")
                .where(F.col("_deleted_at").isNull() | (F.col("seq") > F.col("_deleted_at")))
                .select(*_COLUMN, "value", "timestamp"))


def apply_mutations(cells: DataFrame, mutations: DataFrame, default_family: str | None = None,
                    now_micros: int = 0) -> DataFrame:
    """The cells after one bulk write.

    Within an entry the deletes act after the sets; a later entry (by ``seq``) may set a
    deleted cell again. A set with an existing timestamp replaces that version.
    """
    sets, deletes = mutation_cells(mutations, default_family, now_micros)
    written = _written_cells(sets, deletes)
    kept = (cells.join(deletes, _COLUMN, "left_anti")
                 .join(written, [*_COLUMN, "timestamp"], "left_anti"))
    return kept.select(*_COLUMN, "value", "timestamp").unionByName(written)


def write_cells(table: VersionedTable, mutations: DataFrame, default_family: str | None = None,
                now_micros: int = 0) -> int:
    """Publish a bulk write, with the meaning of ``apply_mutations``; returns the number of row
    entries. Only files that hold a deleted or replaced cell are written again."""
    mutations = materialise(mutations, "mutations")
    sets, deletes = mutation_cells(mutations, default_family, now_micros)
    written = materialise(_written_cells(sets, deletes), "written")
    gone = {"delete_matched": True, "insert_unmatched": False}
    table.execute_batch([
        Merge(deletes.select(*_COLUMN), _COLUMN, **gone),
        Merge(written.select(*_COLUMN, "timestamp"), [*_COLUMN, "timestamp"], **gone), Insert(written)])
    return mutations.count()


def _chosen(keys: list[str] | None, prefix: str | None, start: str | None, end: str | None) -> Column:
    key = F.col("row_key")
    if keys:
        return key.isin(list(keys))
    if prefix:
        return key.startswith(prefix)
    if start is None and end is None:
        raise ValueError("give keys, a prefix or a range")
    condition = F.lit(True)
    if start is not None:
        condition = condition & (key >= start)
    if end is not None:
        condition = condition & (key < end)
    return condition


def remaining_cells(cells: DataFrame, keys: list[str] | None = None, prefix: str | None = None,
                    start: str | None = None, end: str | None = None) -> DataFrame:
    """The cells left after deleting whole rows by keys, else prefix, else range."""
    return cells.where(~_chosen(keys, prefix, start, end))


def delete_rows(table: VersionedTable, keys: list[str] | None = None, prefix: str | None = None,
                start: str | None = None, end: str | None = None) -> dict[str, int]:
    """Deletes rows; ``requested`` counts keys asked for, ``deleted`` rows that existed."""
    condition = _chosen(keys, prefix, start, end)
    found = table.read().where(condition).select("row_key").distinct().count()
    table.execute(Delete(condition))
    return {"requested": len(keys) if keys else found, "deleted": found}
