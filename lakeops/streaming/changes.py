"""Incremental detection: changed objects, change-stream tokens and change records."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.session import materialise

# What a change detection reports.
ON = ("CREATE", "UPDATE", "CREATE_OR_UPDATE")
# Fixed value: allowed names of a change stream.
STREAM_NAME = r"^[a-zA-Z0-9_]+$"


def version_text(generation: Column, metageneration: Column) -> Column:
    """The version of an object as ``generation/metageneration``, missing ones as 0."""
    return F.concat_ws("/", F.coalesce(generation, F.lit(0)).cast("string"), F.coalesce(metageneration, F.lit(0)).cast("string"))


def newest_versions(listing: DataFrame) -> DataFrame:
    """``uri, version`` of the newest generation of each object, aggregated map-side first."""
    rank = F.struct(F.coalesce("generation", F.lit(0)), F.coalesce("metageneration", F.lit(0)))
    newest = listing.groupBy("uri").agg(F.max(rank).alias("_v"))
    return newest.select("uri", version_text(F.col("_v.col1"), F.col("_v.col2")).alias("version"))


def detect_changes(listing: DataFrame, state: DataFrame, on: str = "CREATE_OR_UPDATE",
                   now_ms: int | None = None, ttl_ms: int | None = None,
                   max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Changed objects and the state to keep.

    ``state`` holds ``uri, version, seen_ms``. An object without a live entry is a CREATE, one
    with another version an UPDATE. The cap applies to the changes, after the comparison; the
    state takes in only what was let through, so capped changes come with the next poll.
    """
    if on not in ON:
        raise ValueError(f"on is one of {ON}")
    live = state
    if ttl_ms is not None:
        live = state.where(F.col("seen_ms") >= (now_ms - ttl_ms))
    known = live.select("uri", F.col("version").alias("_known"), F.col("seen_ms").alias("_seen"))
    both = newest_versions(listing).join(known, "uri", "full_outer")
    change = (F.when(F.col("version").isNull(), F.lit(None))
               .when(F.col("_known").isNull(), "CREATE")
               .when(F.col("_known") != F.col("version"), "UPDATE"))
    # written down once: changes and state must come from the same look at the listing
    compared = materialise(both.withColumn("change", change), "compared")
    fires = F.col("change").isNotNull() if on == "CREATE_OR_UPDATE" else F.col("change") == on
    changed = compared.where(fires).select("uri", "version", "change")
    if max_files is not None:
        changed = changed.orderBy("uri").limit(max_files)
        passed = changed.select("uri", F.lit(True).alias("_passed"))
        compared = compared.join(passed, "uri", "left")
        taken = F.coalesce("_passed", F.lit(False)) | ~F.coalesce(fires, F.lit(False))
    else:
        taken = F.lit(True)
    advance = F.col("version").isNotNull() & taken
    kept = compared.select(
        "uri",
        F.when(advance, F.col("version")).otherwise(F.col("_known")).alias("version"),
        F.when(advance & F.col("change").isNotNull(), F.lit(now_ms).cast("bigint"))
         .otherwise(F.col("_seen")).alias("seen_ms")).where(F.col("version").isNotNull())
    return changed, kept


def _object_versions(on: str, ttl_ms: int | None) -> StatefulProcessor:
    """Keeps the newest version per object and reports when it moves on.

    The class is local, so it travels with the query and needs no module on the other side.
    """
    class ObjectVersions(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "generation bigint, metageneration bigint", ttl_ms)

        def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
            newest = max(
                max(zip(batch["generation"].fillna(0), batch["metageneration"].fillna(0))) for batch in rows)
            newest = (int(newest[0]), int(newest[1]))
            old = tuple(self.seen.get()) if self.seen.exists() else None
            if old is not None and newest <= old:
                return
            self.seen.update(newest)
            change = "CREATE" if old is None else "UPDATE"
            if on in (change, "CREATE_OR_UPDATE"):
                yield pd.DataFrame({
                    "uri": [key[0]], "change": [change],
                    "version": [f"{newest[0]}/{newest[1]}"]})

        def close(self) -> None:
            pass

    return ObjectVersions()


def detect_changes_stream(listing: DataFrame, on: str = "CREATE_OR_UPDATE",
                          ttl_ms: int | None = None) -> DataFrame:
    """Streaming form over listing rows ``uri, generation, metageneration``.

    State lives in the RocksDB provider, which the session must name in
    ``spark.sql.streaming.stateStore.providerClass``. With a time to live, use a
    processing-time trigger: the clock keeps an available-now query from ending. Before the shuffle each Arrow batch is
    reduced to the newest version per object, so an object listed very often does not send
    all its rows to one task.
    """
    if on not in ON:
        raise ValueError(f"on is one of {ON}")

    def newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield (batch.sort_values(["generation", "metageneration"])
                        .drop_duplicates("uri", keep="last"))

    columns = "uri string, generation bigint, metageneration bigint"
    reduced = listing.select("uri", F.col("generation").cast("bigint"),
                             F.col("metageneration").cast("bigint")).mapInPandas(newest, columns)
    # only a time to live needs a clock
    return reduced.groupBy("uri").transformWithStateInPandas(
        _object_versions(on, ttl_ms), "uri string, change string, version string",
        outputMode="append", timeMode="ProcessingTime" if ttl_ms else "None")


# ---------------------------------------------------------------- change streams

def partition_tokens(records: DataFrame) -> DataFrame:
    """Child partition tokens out of nested ``ChangeRecord`` arrays."""
    return (records.select(F.explode("ChangeRecord").alias("r"))
                   .select(F.explode("r.child_partitions_record").alias("p"))
                   .select(F.explode("p.child_partitions").alias("c"))
                   .select(F.col("c.token").alias("token"))
                   .where(F.col("token").isNotNull()))


def window_start(now: Column, look_back: str, earliest: Column | None = None) -> Column:
    """Start of the look-back, not before the earliest time that can still be read."""
    start = now - F.expr(look_back)
    return start if earliest is None else F.greatest(start, earliest)


def read_changes(records: DataFrame, stream: str, now: Column, look_back: str,
                 earliest: Column | None = None) -> DataFrame:
    """Data changes in ``[now - look_back, now]`` as one row each, with their token."""
    if not re.match(STREAM_NAME, stream):
        raise ValueError("a stream name has letters, digits and underscores only")
    changes = (records.select("partition_token", F.explode("ChangeRecord").alias("r"))
                      .select("partition_token", F.explode("r.data_change_record").alias("c"))
                      .select("partition_token", "c.*"))
    return changes.where(F.col("commit_ts").between(window_start(now, look_back, earliest), now))


def count_changes(records: DataFrame, now: Column, look_back: str,
                  earliest: Column | None = None) -> DataFrame:
    """Rows and data changes per token. Arrays are counted where they are, not exploded."""
    start = window_start(now, look_back, earliest)
    present = F.filter(F.col("ChangeRecord.data_change_record"), lambda changes: changes.isNotNull())
    times = F.flatten(present).getField("commit_ts")
    per_row = F.size(F.filter(times, lambda t: t.between(start, now)))
    return (records.select("partition_token", per_row.alias("n")).where("n > 0")
                   .groupBy("partition_token")
                   .agg(F.count(F.lit(1)).alias("row_count"), F.sum("n").cast("bigint").alias("change_count")))


def poll_changes(records: DataFrame, stream: str, now: Column, look_back: str) -> DataFrame | None:
    """The changes of the window, or None when rows or changes are zero."""
    changes = read_changes(records, stream, now, look_back)
    return changes if changes.head(1) else None
