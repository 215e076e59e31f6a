import time

import pytest
from pyspark.sql import functions as F

from lakeops.operators.versioned import VersionedTable
from lakeops.streaming import changes, watch
from lakeops.streaming.consume import consume_batch, consume_stream, poll, publish, publish_kafka, read_kafka
from lakeops.streaming.write_stream import stream_write

MESSAGES = "data string, attributes map<string,string>, message_id string, ordering_key string, seq bigint"


def source(spark, path, files_per_batch=None):
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@pytest.fixture
def topic(spark, folder):
    """Eight messages in eight files."""
    spark.createDataFrame([(f"m{i}", None, str(i), None, i) for i in range(8)], MESSAGES) \
         .withColumn("data", F.col("data").cast("binary")).repartitionByRange(8, "seq").write.parquet(f"{folder}/topic")
    return f"{folder}/topic"


def test_publish_and_consume_text(spark, folder):
    rows = spark.createDataFrame([("Hello World", None, None, None, 0), (None, {"k": "v"}, None, None, 1)], MESSAGES)
    assert publish(rows, f"{folder}/t") == 2
    got = consume_batch(source(spark, f"{folder}/t"), max_records=2)
    assert got.count == 2
    assert {(r["data"], (r["attributes"] or {}).get("k")) for r in got.rows.collect()} == {("Hello World", None), (None, "v")}
    assert got.rows.where("message_id is null").count() == 0


def test_json_payloads(spark, folder):
    rows = spark.sql("select named_struct('hello', 'world') as data")
    publish(rows, f"{folder}/t", "JSON")
    assert consume_batch(spark.read.parquet(f"{folder}/t"), "JSON", max_records=9).rows.first()["data"] == '{"hello":"world"}'
    publish(spark.sql("select 'not json' as data"), f"{folder}/s", "JSON")
    assert consume_batch(spark.read.parquet(f"{folder}/s"), max_records=9).rows.first()["data"] == "not json"
    with pytest.raises(Exception):
        consume_batch(spark.read.parquet(f"{folder}/s"), "JSON", max_records=9)


def test_kafka_needs_its_package(spark):
    options = {"kafka.bootstrap.servers": "nowhere:1", "subscribe": "t"}
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        publish_kafka(spark.sql("select 'a' as data, map('k', 'v') as attributes"), "t", options)
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_kafka(spark, options)


def test_order_per_key_along_the_files(spark, folder):
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("data"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 50)).alias("ordering_key"), F.xxhash64("id").alias("seq"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish(rows, f"{folder}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(f"{folder}/t").select(
        "ordering_key", "seq", F.col("_metadata.file_name").alias("file")).withColumn("place", F.monotonically_increasing_id())
    got = stored.orderBy("file", "place").collect()
    hot = [r for r in got if r["ordering_key"] == "hot"]
    assert len({r["file"] for r in hot}) > 1
    assert [r["seq"] for r in hot] == sorted(r["seq"] for r in hot) and len(got) == 4000


def test_bounded_consume_resumes(spark, folder, topic):
    messages = source(spark, topic, 1)
    first = consume_batch(messages, max_records=3, checkpoint=f"{folder}/c")
    assert first.count == 3
    rest = consume_batch(messages, max_records=100, checkpoint=f"{folder}/c")
    assert rest.count == 5
    together = {r["data"] for r in first.rows.union(rest.rows).collect()}
    assert together == {f"m{i}" for i in range(8)}
    assert poll(messages, max_duration=60, checkpoint=f"{folder}/c") is None
    with pytest.raises(ValueError):
        consume_batch(messages)


def test_calls_take_exactly_their_bound_and_every_message_once(spark, folder):
    spark.range(100).selectExpr("cast(concat('m', id) as binary) as data").repartition(6).write.parquet(f"{folder}/t")
    messages = spark.readStream.schema("data binary").option("maxFilesPerTrigger", 2).parquet(f"{folder}/t")
    seen = []
    for _ in range(15):
        got = consume_batch(messages, max_records=7, checkpoint=f"{folder}/c")
        assert got.count == len(rows := got.rows.collect())
        seen.append([r["data"] for r in rows])
    assert [len(x) for x in seen] == [7] * 14 + [2]
    assert sorted(x for part in seen for x in part) == sorted(f"m{i}" for i in range(100))
    assert consume_batch(messages, max_records=7, checkpoint=f"{folder}/c").count == 0


def test_a_call_that_fails_takes_nothing(spark, folder, monkeypatch):
    from lakeops.streaming import consume
    spark.range(20).selectExpr("cast(concat('m', id) as binary) as data").repartition(2).write.parquet(f"{folder}/t")
    messages = spark.readStream.schema("data binary").parquet(f"{folder}/t")
    put = consume.put_json_if_absent
    monkeypatch.setattr(consume, "put_json_if_absent", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        consume_batch(messages, max_records=6, checkpoint=f"{folder}/c")
    monkeypatch.setattr(consume, "put_json_if_absent", put)
    got = [r["data"] for n in (6, 100) for r in consume_batch(messages, max_records=n, checkpoint=f"{folder}/c").rows.collect()]
    assert sorted(got) == sorted(f"m{i}" for i in range(20))


def test_static_frames_are_cut_exactly(spark, folder):
    spark.range(50).selectExpr("cast(id as string) as data").repartition(7).write.parquet(f"{folder}/t")
    for bound, expected in ((0, 0), (1, 1), (33, 33), (50, 50), (80, 50)):
        assert consume_batch(spark.read.parquet(f"{folder}/t"), max_records=bound).count == expected


def test_continuous_consume_stops(spark, folder, topic):
    taken = []
    query = consume_stream(source(spark, topic, 2), lambda batch, n: taken.extend(r["data"] for r in batch.collect()),
                           f"{folder}/c", interval="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert sorted(taken) == [f"m{i}" for i in range(8)] and not query.isActive


@pytest.mark.parametrize("mode, versions", [("DEFAULT", 5), ("COMMITTED", 5), ("PENDING", 2)])
def test_write_modes(spark, folder, topic, mode, versions):
    stream = source(spark, topic, 2).select("message_id", "seq")
    target = VersionedTable.create(spark, f"{folder}/sink", spark.read.parquet(topic).select("message_id", "seq").limit(0))
    done = stream_write(stream, target, "w", mode, f"{folder}/c1")
    assert done.rows == 8 and target.read().count() == 8 and len(target.versions()) == versions
    assert done.version == target.versions()[-1] and done.committed_ms > 0
    # the same checkpoint has nothing new
    assert stream_write(stream, target, "w", mode, f"{folder}/c1").rows == 0
    # another writer's rows are not counted, nor mixed up
    other = stream_write(stream, target, "w2", mode, f"{folder}/c3")
    assert other.rows == 8 and target.read().count() == 16
    # a lost checkpoint delivers everything again, which only at-least-once may do unasked
    if mode != "DEFAULT":
        with pytest.raises(ValueError, match="another checkpoint"):
            stream_write(stream, target, "w", mode, f"{folder}/c2")
        with pytest.raises(ValueError, match="needs a checkpoint"):
            stream_write(stream, target, "w", mode)
    assert stream_write(stream, target, "w", mode, f"{folder}/c2", replay=True).rows == 8
    assert target.read().count() == 24
    with pytest.raises(ValueError):
        stream_write(stream, VersionedTable(spark, f"{folder}/none"), "w", mode, f"{folder}/c4")


@pytest.mark.parametrize("mode", ["DEFAULT", "COMMITTED", "PENDING"])
def test_a_second_call_keeps_what_the_first_one_wrote(spark, folder, topic, mode):
    rows = spark.read.parquet(topic).select("message_id", "seq")
    target = VersionedTable.create(spark, f"{folder}/sink", rows.limit(0))
    stream_write(source(spark, topic, 2).select("message_id", "seq"), target, "w", mode, f"{folder}/c1")
    first = target.versions()[-1]
    spark.range(100, 103).selectExpr("cast(id as string) as message_id", "id as seq").write.parquet(f"{folder}/more")
    done = stream_write(source(spark, f"{folder}/more", 1), target, "w", mode, f"{folder}/c2", replay=True)
    assert done.rows == 3
    assert sorted(r["seq"] for r in target.read().collect()) == [*range(8), 100, 101, 102]
    assert sorted(r["seq"] for r in target.read(first).collect()) == list(range(8))


def test_pending_rows_stay_invisible_until_the_commit(spark, folder, topic):
    stream = source(spark, topic, 2).select("message_id", F.expr("cast(if(seq = 7, raise_error('late'), seq) as bigint)").alias("seq"))
    target = VersionedTable.create(spark, f"{folder}/sink", spark.read.parquet(topic).select("message_id", "seq").limit(0))
    with pytest.raises(Exception, match="late"):
        stream_write(stream, target, "w", "PENDING", f"{folder}/c")
    assert target.read().count() == 0
    # the restart finds the batches staged before the failure
    stream_write(source(spark, topic, 2).select("message_id", "seq"), target, "w", "PENDING", f"{folder}/c")
    assert sorted(r["seq"] for r in target.read().collect()) == list(range(8))


def test_watch_sql(spark):
    assert watch.watch_sql(spark, "SELECT * FROM VALUES (1), (2) AS t(n) WHERE n > 5") is None
    assert watch.watch_sql(spark, "SELECT * FROM VALUES (1), (2) AS t(n) WHERE n > @low", {"low": 1}).count() == 1


def test_log_levels(spark, folder):
    logs = spark.createDataFrame([(s,) for s in ("DEBUG", "WARNING", "ERROR", "CRITICAL", "ALERT", "EMERGENCY", "NOTICE", "DEFAULT")], "severity string")
    watch.route_logs(logs, f"{folder}/logs")
    got = {r["level"]: r["count"] for r in spark.read.parquet(f"{folder}/logs").groupBy("level").count().collect()}
    assert got == {"debug": 1, "warn": 1, "error": 4, "info": 2}


LISTING = "uri string, generation bigint, metageneration bigint"


def test_object_changes_over_polls(spark):
    state = spark.createDataFrame([], "uri string, version string, seen_ms bigint")
    v1 = spark.createDataFrame([("a", 1, 1), ("b", 1, None), ("a", 2, 1)], LISTING)
    changed, state = changes.detect_changes(v1, state, now_ms=10, max_files=1)
    assert [tuple(r) for r in changed.collect()] == [("a", "2/1", "CREATE")]
    changed, state = changes.detect_changes(v1, state, now_ms=20, max_files=1)
    assert [tuple(r) for r in changed.collect()] == [("b", "1/0", "CREATE")]
    v2 = spark.createDataFrame([("a", 2, 5), ("b", 1, 0), ("c", 9, 9)], LISTING)
    assert {r["uri"] for r in changes.detect_changes(v2, state, "UPDATE", now_ms=30)[0].collect()} == {"a"}
    assert {r["uri"] for r in changes.detect_changes(v2, state, "CREATE", now_ms=30)[0].collect()} == {"c"}
    changed, state = changes.detect_changes(v2, state, now_ms=30)
    assert {r["uri"]: r["change"] for r in changed.collect()} == {"a": "UPDATE", "c": "CREATE"}
    assert changes.detect_changes(v2, state, now_ms=40)[0].count() == 0
    # b was last seen moving at 20, so its entry is the one that has run out
    assert [r["uri"] for r in changes.detect_changes(v2, state, now_ms=45, ttl_ms=20)[0].collect()] == ["b"]


@pytest.mark.parametrize("ttl", [None, 86_400_000])
def test_object_changes_as_a_stream(spark, folder, ttl):
    put = lambda rows: spark.createDataFrame(rows, LISTING).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    put([("a", 1, 1), ("b", 1, 1)])
    query = (changes.detect_changes_stream(source(spark, f"{folder}/in"), ttl_ms=ttl)
             .writeStream.format("memory").queryName(f"changes_{ttl or 0}").outputMode("append")
             .option("checkpointLocation", f"{folder}/c").start())
    seen = lambda: sorted(tuple(r)[:2] for r in spark.table(f"changes_{ttl or 0}").collect())

    def wait(n):
        limit = time.monotonic() + 60
        while len(seen()) < n and time.monotonic() < limit:
            time.sleep(0.3)
    try:
        wait(2)
        put([("a", 2, 1), ("b", 1, 1), ("c", 1, 1), ("a", 3, 1)])
        wait(4)
        assert seen() == [("a", "CREATE"), ("a", "UPDATE"), ("b", "CREATE"), ("c", "CREATE")]
    finally:
        query.stop()


def test_change_records(spark):
    kind = ("partition_token string, ChangeRecord array<struct<data_change_record:array<struct<commit_ts:timestamp,mod_type:string>>,"
            "child_partitions_record:array<struct<child_partitions:array<struct<token:string>>>>>>")
    import datetime as dt
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    records = spark.createDataFrame([
        ("t0", [([(at(1), "INSERT"), (at(2), "UPDATE")], None), (None, [([("t1",), (None,)],), (None,)])]),
        ("t1", [([(at(9), "DELETE")], [])]), ("t2", None)], kind)
    assert [r[0] for r in changes.partition_tokens(records).collect()] == ["t1"]
    now = F.to_timestamp(F.lit("2024-01-01 00:00:05"))
    assert changes.read_changes(records, "users_stream", now, "INTERVAL 1 HOUR").count() == 2
    counts = changes.count_changes(records, now, "INTERVAL 1 HOUR", F.to_timestamp(F.lit("2024-01-01 00:00:02"))).collect()
    assert [tuple(r) for r in counts] == [("t0", 1, 1)]
    assert changes.poll_changes(records, "s", F.to_timestamp(F.lit("2023-01-01")), "INTERVAL 1 HOUR") is None
    with pytest.raises(ValueError):
        changes.read_changes(records, "bad-name", now, "INTERVAL 1 HOUR")
