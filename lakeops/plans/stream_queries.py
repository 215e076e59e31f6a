"""Registered queries: messages, streaming writes, watches, incremental detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import docs as doc_ops
from lakeops.operators import widecol as wide_ops
from lakeops.operators.versioned import VersionedTable
from lakeops.plans.fixtures import (CELLS_SQL, OBJECTS_SQL, cells_of, change_records_of, documents_of,
                                    messages_of, objects_of, points_of, split_and_merged_records, stream, table)
from lakeops.plans.load_queries import DOCUMENTS_SQL
from lakeops.plans.registry import query
from lakeops.session import scratch_dir
from lakeops.sources import docs
from lakeops.sources.series import query_series
from lakeops.streaming import changes, lineage, watch
from lakeops.streaming.consume import consume_batch, consume_stream, publish
from lakeops.streaming.triggers import read_events, watch_table, watch_windows
from lakeops.streaming.write_stream import stream_write


# ---------------------------------------------------------------- messages

@query("messages_published", """
  select user_id as ordering_key, count(*) as messages, min(event_id) as first_seq, max(event_id) as last_seq,
         cast(sum(strlen(props)) as bigint) as bytes from events group by 1""")
def messages_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "topic")
    publish(messages_of(table(spark, sf_dir, "events")), path)
    return spark.read.parquet(path).groupBy(F.col("ordering_key").cast("bigint").alias("ordering_key")).agg(
        F.count(F.lit(1)).alias("messages"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.sum(F.octet_length("data")).cast("bigint").alias("bytes"))


@query("messages_encoded_as_json", """
  select event_id, '{"type":"' || event_type || '","user":' || user_id || '}' as data from events""")
def messages_encoded_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "topic")
    events = table(spark, sf_dir, "events").select(
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("data"),
        F.col("event_id").cast("string").alias("message_id"))
    publish(events, path, "JSON")
    got = consume_batch(spark.read.parquet(path), "JSON", max_duration=600).rows
    return got.select(F.col("message_id").cast("bigint").alias("event_id"), "data")


@query("messages_consumed", "select cast(event_id as varchar) as message_id, props as data, event_type from events")
def messages_consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = consume_batch(messages_of(stream(spark, sf_dir, "events")), "STRING", max_duration=3600)
    return got.rows.select("message_id", "data", F.col("attributes")["event_type"].alias("event_type"))


@query("messages_consumed_exactly", """
  with a as (select count(*) as n, count(*) // 6 as part from events)
  select cast(call as bigint) as call, case when call < 4 then part else n - 4 * part end as taken, n as all_messages
  from a, range(5) r(call)""")
def messages_consumed_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four calls take a sixth each, out of larger batches, and a fifth the rest; every message once."""
    checkpoint, events, files = scratch_dir(spark, "checkpoint"), table(spark, sf_dir, "events"), scratch_dir(spark, "files")
    events.repartition(3, "event_id").write.parquet(files)
    messages = messages_of(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files))
    part = events.count() // 6
    calls = [consume_batch(messages, max_records=part if n < 4 else None, max_duration=3600, checkpoint=checkpoint) for n in range(5)]
    rows = reduce(DataFrame.unionByName, [got.rows.select("message_id", F.lit(n).cast("bigint").alias("call")) for n, got in enumerate(calls)])
    once = rows.groupBy("message_id").agg(F.count(F.lit(1)).alias("times"), F.min("call").alias("call")).where("times = 1")
    total = once.agg(F.count(F.lit(1)).alias("all_messages"))
    return once.groupBy("call").agg(F.count(F.lit(1)).alias("taken")).join(F.broadcast(total))


@query("messages_consumed_continuously", "select event_type, count(*) as n from events group by 1")
def messages_consumed_continuously(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "handled")

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    consume_stream(messages_of(stream(spark, sf_dir, "events")), handler,
                   scratch_dir(spark, "checkpoint"), interval=None).awaitTermination()
    return spark.read.parquet(out).groupBy(F.col("attributes")["event_type"].alias("event_type")).agg(
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- streaming writes

def _streamed(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    events, files = table(spark, sf_dir, "events"), scratch_dir(spark, "events")
    events.repartition(8, "event_id").write.parquet(files)
    target = VersionedTable.create(spark, scratch_dir(spark, "sink"), events.limit(0))
    batches = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(files)
    stream_write(batches, target, "events", mode, scratch_dir(spark, "checkpoint"))
    return target.read()


for _mode in ("DEFAULT", "COMMITTED", "PENDING"):
    query(f"stream_write_{_mode.lower()}", "select * from events")(
        lambda spark, sf_dir, mode=_mode: _streamed(spark, sf_dir, mode))


# ---------------------------------------------------------------- wide-column and document writes

@query("cells_written", f"""
  with c as ({CELLS_SQL})
  select row_key, family, qualifier, value, timestamp from c
  where not (qualifier = 'value' and row_key in (select row_key from c where qualifier = 'event_type' and value = 'error'))
  union all select row_key, 'meta', 'checked', 'yes', 1800000000000000 from c where qualifier = 'event_type' and value = 'error'""")
def cells_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cells_of(table(spark, sf_dir, "events"))
    errors = cells.where("qualifier = 'event_type' and value = 'error'").select("row_key")
    mark = errors.select("row_key", F.lit("meta").alias("family"),
                         F.create_map(F.lit("checked"), F.lit("yes")).alias("cells"),
                         F.array().cast("array<string>").alias("delete_cells"), F.lit(0).alias("seq"))
    # the second entry falls back to the default family
    drop = errors.select("row_key", F.lit(None).cast("string").alias("family"),
                         F.create_map().cast("map<string,string>").alias("cells"),
                         F.array(F.lit("value")).alias("delete_cells"), F.lit(1).alias("seq"))
    table_ = VersionedTable.create(spark, scratch_dir(spark, "cells"), cells, sort_by=["row_key"])
    wide_ops.write_cells(table_, mark.unionByName(drop), "cf1", 1_800_000_000_000_000)
    return table_.read()


@query("cells_deleted", f"""
  with c as ({CELLS_SQL}) select * from c
  where not starts_with(row_key, 'u001') and not (row_key >= 'u0030' and row_key < 'u0050')""")
def cells_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = VersionedTable.create(spark, scratch_dir(spark, "cells"), cells_of(table(spark, sf_dir, "events")),
                                   sort_by=["row_key"])
    wide_ops.delete_rows(table_, prefix="u001")
    wide_ops.delete_rows(table_, start="u0030", end="u0050")
    return table_.read()


@query("documents_set", f"""
  with d as ({DOCUMENTS_SQL})
  select doc_id, name, segment from d where segment is not null
  union all select doc_id, null, null from d where segment is null""")
def documents_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    collection = documents_of(table(spark, sf_dir, "customer"))
    # documents without a segment are replaced by empty ones
    empty = docs.doc_query(collection, [("segment", "EQUAL_TO", None)]).select(
        "doc_id", F.lit(None).cast("string").alias("data"))
    after = doc_ops.doc_set(collection, empty)
    return after.select("doc_id", docs.doc_field("name").alias("name"), docs.doc_field("segment").alias("segment"))


@query("documents_deleted", f"with d as ({DOCUMENTS_SQL}) select doc_id from d where segment is not null")
def documents_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    collection = documents_of(table(spark, sf_dir, "customer"))
    gone = docs.doc_query(collection, [("segment", "EQUAL_TO", None)]).select("doc_id")
    return doc_ops.doc_delete(collection, gone).select("doc_id")


@query("documents_stored", f"""
  with d as ({DOCUMENTS_SQL}) select doc_id, case when segment = 'BUILDING' then 'built' else name end as name from d where segment is not null""")
def documents_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored collection after replacing some documents and deleting others."""
    collection = doc_ops.DocCollection(spark, scratch_dir(spark, "collection"), buckets=16)
    collection.set(documents_of(table(spark, sf_dir, "customer")))
    built = docs.doc_query(collection.read(), [("segment", "EQUAL_TO", "BUILDING")])
    collection.set(built.select("doc_id", F.lit('{"name":"built"}').alias("data")))
    bare = docs.doc_query(collection.read(), [("segment", "EQUAL_TO", None), ("name", "NOT_EQUAL_TO", "built")])
    collection.delete(bare.select("doc_id"))
    return collection.read().select("doc_id", docs.doc_field("name").alias("name"))


# ---------------------------------------------------------------- watches

@query("sql_watched", "select user_id, count(*) as n from events where event_type = 'error' group by 1 having count(*) > 5")
def sql_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("watched_events")
    text = "SELECT user_id, count(*) AS n FROM watched_events WHERE event_type = @type GROUP BY 1 HAVING count(*) > 5"
    rows = watch.watch_sql(spark, text, {"type": "error"})
    return rows if rows is not None else spark.createDataFrame([], "user_id bigint, n bigint")


@query("sql_watched_as_stream", "select event_id, value from events where event_type = 'error' and value > 20")
def sql_watched_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "emitted")

    def emit(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    watch.watch_stream(stream(spark, sf_dir, "events"), "new_events",
                       "SELECT event_id, value FROM new_events WHERE event_type = 'error' AND value > 20",
                       emit, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("event_id bigint, value double").parquet(out).select("event_id", "value")


@query("table_watched_as_stream", """
  select user_id, 'ENTER' as change from events where event_type = 'error' group by user_id having count(*) > 3""")
def table_watched_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with more than three errors over all batches, each reported once."""
    out, files, events = scratch_dir(spark, "fired"), scratch_dir(spark, "files"), table(spark, sf_dir, "events")
    events.repartition(4, "event_id").write.parquet(files)
    base = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    watch_table(base.where("event_type = 'error'"), {"user_id": "user_id"}, {"n": "count(*)"}, "n > 3", out,
                scratch_dir(spark, "checkpoint")).awaitTermination()
    return read_events(spark, out).select("user_id", "change")


@query("series_watched_as_stream", """
  with polled as (
    select t.event_type, i.instant,
           coalesce(sum(cast(round(e.value * 100) as bigint)) > 5000 * count(e.event_id), false) as holds
    from (select distinct event_type from events) t
    cross join (select unnest(generate_series(date_trunc('day', min(ts)), max(ts) - interval 10 minute, interval 6 hour)) as instant from events) i
    left join events e on e.event_type = t.event_type and e.ts >= i.instant - interval 24 hour and e.ts < i.instant
    group by t.event_type, i.instant),
  steps as (select *, coalesce(lag(holds) over (partition by event_type order by instant), false) as held from polled)
  select event_type, epoch_us(instant) as at_us, case when holds then 'ENTER' else 'LEAVE' end as change from steps where holds <> held""")
def series_watched_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types whose mean value of the last day exceeds 50, looked at every six hours."""
    out = scratch_dir(spark, "entered")
    points = stream(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("end_ts"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    watch_windows(points, ["event_type"], {"total": "sum(cents)", "n": "count(*)"}, "total > 5000 * n", out,
                  scratch_dir(spark, "checkpoint"), window="24 hours", slide="6 hours", delay="10 minutes").awaitTermination()
    return read_events(spark, out).select("event_type", F.unix_micros("at").alias("at_us"), "change")


@query("cells_watched", f"""
  with c as ({CELLS_SQL}) select * from c where family = 'meta'
    and timestamp >= epoch_us(timestamp '2024-01-30 00:00:00')""")
def cells_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = 1_706_659_200_000_000  # 2024-01-31 00:00 UTC
    return watch.watch_cells(cells_of(table(spark, sf_dir, "events")), "meta", now, 86_400)


@query("cells_watched_as_stream", f"with c as ({CELLS_SQL}) select * from c where family = 'cf1'")
def cells_watched_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "cells")
    events = stream(spark, sf_dir, "events")
    # two overlapping polls deliver every cell twice
    polls = cells_of(events).unionByName(cells_of(events))
    (watch.watch_cells_stream(polls, "cf1", "60 days").writeStream.format("parquet").trigger(availableNow=True)
          .option("checkpointLocation", scratch_dir(spark, "checkpoint")).start(out).awaitTermination())
    return spark.read.parquet(out)


@query("series_watched", """
  select 'app/' || event_type as metric_type, count(distinct user_id) as series, count(*) as points from events
  where event_type = 'error' and ts between timestamp '2024-01-30 00:00:00' and timestamp '2024-01-31 00:00:00' group by 1""")
def series_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    points = points_of(table(spark, sf_dir, "events"))
    found = watch.watch_series(points, "metric_type = 'app/error'", now, "INTERVAL 1 DAY")
    if found is None:
        found = query_series(points.limit(0), "true", now)
    return found.groupBy("metric_type").agg(
        F.count_distinct(F.map_entries("labels")).alias("series"),
        F.sum(F.size("points")).cast("bigint").alias("points"))


@query("points_pushed", """
  select 'app/' || event_type as metric_type, case when event_type = 'purchase' then 'CUMULATIVE' else 'GAUGE' end as kind,
         value, case when event_type = 'purchase' then 60 else 0 end as seconds from events""")
def points_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "events").select(
        F.concat(F.lit("app/"), "event_type").alias("metric_type"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
        F.when(F.col("event_type") == "purchase", "CUMULATIVE").alias("kind"), "value")
    path = scratch_dir(spark, "points")
    watch.push_points(metrics, F.to_timestamp(F.lit("2024-01-31 00:00:00"))).write.parquet(path)
    return spark.read.parquet(path).select(
        "metric_type", "kind", "value",
        (F.unix_seconds("end_ts") - F.unix_seconds("start_ts")).cast("int").alias("seconds"))


@query("logs_routed", """
  select event_id, case event_type when 'error' then 'error' when 'purchase' then 'error' when 'view' then 'debug'
         when 'click' then 'warn' else 'info' end as level from events""")
def logs_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = (F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "ALERT")
                 .when(F.col("event_type") == "view", "DEBUG").when(F.col("event_type") == "click", "WARNING")
                 .otherwise("NOTICE"))
    out = scratch_dir(spark, "logs")
    watch.route_logs(stream(spark, sf_dir, "events").select("event_id", severity.alias("severity")), out,
                     scratch_dir(spark, "checkpoint"))
    return spark.read.parquet(out).select("event_id", F.col("level").cast("string"))


# ---------------------------------------------------------------- incremental detection

def _listing_and_state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """English pages are new, Spanish ones are known in an older version, others unchanged."""
    listing = objects_of(table(spark, sf_dir, "pages"))
    known = changes.newest_versions(listing).where(~F.col("uri").startswith("gs://bucket/en/"))
    older = F.concat("version", F.lit("-older"))
    spanish = F.col("uri").startswith("gs://bucket/es/")
    return listing, known.select("uri", F.when(spanish, older).otherwise(F.col("version")).alias("version"),
                                 F.lit(1_000).cast("bigint").alias("seen_ms"))


NEWEST_SQL = f"""
  o as ({OBJECTS_SQL}), v as (select uri, max(generation) || '/1' as version from o group by uri)"""


@query("objects_changed", f"""
  with {NEWEST_SQL}
  select uri, version, case when starts_with(uri, 'gs://bucket/en/') then 'CREATE' else 'UPDATE' end as change
  from v where starts_with(uri, 'gs://bucket/en/') or starts_with(uri, 'gs://bucket/es/')""")
def objects_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing, state = _listing_and_state(spark, sf_dir)
    return changes.detect_changes(listing, state, now_ms=2_000, ttl_ms=5_000)[0]


@query("objects_changed_state", f"with {NEWEST_SQL} select uri, version from v")
def objects_changed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing, state = _listing_and_state(spark, sf_dir)
    return changes.detect_changes(listing, state, "UPDATE", now_ms=2_000)[1].select("uri", "version")


@query("objects_changed_as_stream", f"with {NEWEST_SQL} select uri, version, 'CREATE' as change from v")
def objects_changed_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = scratch_dir(spark, "changes")
        listing = objects_of(stream(spark, sf_dir, "pages"))
        (changes.detect_changes_stream(listing).writeStream.format("parquet")
                .outputMode("append").trigger(availableNow=True)
                .option("checkpointLocation", scratch_dir(spark, "checkpoint")).start(out).awaitTermination())
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema("uri string, change string, version string").parquet(out)


@query("change_stream_tokens", "select 't' || l_suppkey as token, count(*) as n from lineitem group by 1")
def change_stream_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.partition_tokens(change_records_of(table(spark, sf_dir, "lineitem"))).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))


@query("change_records", """
  select 't' || l_suppkey as partition_token, epoch_us(l_shipdate) as commit_us, l_linestatus as mod_type, l_orderkey as key
  from lineitem where l_shipdate between timestamp '1998-01-01' - interval 30 day and timestamp '1998-01-01'""")
def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = changes.read_changes(change_records_of(table(spark, sf_dir, "lineitem")), "lines",
                                 F.to_timestamp(F.lit("1998-01-01")), "INTERVAL 30 DAYS")
    return found.select("partition_token", F.unix_micros("commit_ts").alias("commit_us"), "mod_type", "key")


@query("change_counts", """
  select 't' || l_suppkey as partition_token, count(*) as row_count, count(*) as change_count from lineitem
  where l_shipdate between timestamp '1997-12-20' and timestamp '1998-01-01' group by 1""")
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.count_changes(change_records_of(table(spark, sf_dir, "lineitem")),
                                 F.to_timestamp(F.lit("1998-01-01")), "INTERVAL 30 DAYS",
                                 F.to_timestamp(F.lit("1997-12-20")))


@query("change_stream_replayed", """
  select key, value, case when latest >= timestamp '1996-01-01' then 2 when latest >= timestamp '1994-01-01' then 1 else 0 end as generation from (
    select o_custkey as key, arg_max(o_totalprice, (o_orderdate, o_orderkey)) as value, max(o_orderdate) as latest,
           arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as status from orders group by 1) where status <> 'P'""")
def change_stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes to their customer, over partitions that split in 1994 and merge in 1996."""
    records = split_and_merged_records(table(spark, sf_dir, "orders"))
    return lineage.replay(records, ["key"]).select("key", "value", "generation")
