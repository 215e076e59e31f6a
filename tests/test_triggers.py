"""Triggers that fire on entry and exit, against polls of the same condition."""

import datetime as dt
import random

import pytest

from lakeops.streaming.triggers import read_events, watch_table, watch_windows


def add(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_count_over_three_files_fires_once(spark, folder):
    for part in ((1, 2), (3, 4), (5, 6)):
        add(spark, f"{folder}/in", [(i,) for i in part], "id bigint")
    base = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    watch_table(base, {}, {"n": "count(*)"}, "n > 3", f"{folder}/out", f"{folder}/check").awaitTermination()
    assert [(r["n"], r["change"], r["batch"]) for r in read_events(spark, f"{folder}/out").collect()] == [(4, "ENTER", 1)]


def test_groups_enter_and_leave_as_polls_see_them(spark, folder):
    """Averages go up and down, keys may be null, and the query is started anew for every file."""
    rng, seen, schema = random.Random(6), [], "k string, v bigint"
    holding, expected = set(), []
    for number in range(4):
        rows = [(rng.choice([None, "a", "b", "c"]), rng.randrange(-9, 10)) for _ in range(6)]
        seen += rows
        add(spark, f"{folder}/in", rows, schema)
        base = spark.readStream.schema(schema).parquet(f"{folder}/in")
        watch_table(base, {"key": "k"}, {"mean": "avg(v)"}, "mean > 0", f"{folder}/out", f"{folder}/check").awaitTermination()
        poll = {k for k in {k for k, _ in seen} if sum(v for x, v in seen if x == k) > 0}
        expected += [(k, "ENTER", number) for k in poll - holding] + [(k, "LEAVE", number) for k in holding - poll]
        holding = poll
    events = [(r["key"], r["change"], r["batch"]) for r in read_events(spark, f"{folder}/out").collect()]
    assert sorted(events, key=str) == sorted(expected, key=str) and {e[1] for e in events} == {"ENTER", "LEAVE"}


def test_a_failed_batch_is_judged_again(spark, folder, monkeypatch):
    from lakeops.streaming import triggers
    add(spark, f"{folder}/in", [(i,) for i in range(5)], "id bigint")
    write = triggers._Ledger.write

    def broken(self, batch_id, events, holding):
        events.write.mode("overwrite").parquet(f"{self.path}/events/batch={batch_id}")
        raise RuntimeError("lost")

    def start():
        base = spark.readStream.schema("id bigint").parquet(f"{folder}/in")
        watch_table(base, {}, {"n": "count(*)"}, "n > 3", f"{folder}/out", f"{folder}/check").awaitTermination()

    monkeypatch.setattr(triggers._Ledger, "write", broken)
    with pytest.raises(Exception):
        start()
    monkeypatch.setattr(triggers._Ledger, "write", write)
    start()
    start()
    assert [tuple(r)[:2] for r in read_events(spark, f"{folder}/out").collect()] == [(5, "ENTER")]


def test_windows_report_what_polls_at_every_instant_see(spark, folder):
    """Series with gaps, a null series, and late files; all instants up to the newest judged one."""
    rng, start = random.Random(2), dt.datetime(2024, 1, 1)
    minute = lambda t: int((t - start).total_seconds() // 60)
    schema, points = "series string, value double, end_ts timestamp", []
    for number in range(5):
        rows = [(s, float(rng.randrange(10)), start + dt.timedelta(minutes=60 * number + rng.randrange(60)))
                for s in ("a", "b", None) for _ in range(rng.randrange(5))]
        points += rows
        add(spark, f"{folder}/in", rows or [("z", 0.0, start)], schema)
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        watch_windows(stream, ["series"], {"total": "sum(value)"}, "total > 9", f"{folder}/out", f"{folder}/check",
                      window="30 minutes", slide="10 minutes", delay="60 minutes").awaitTermination()
    events = read_events(spark, f"{folder}/out").collect()
    assert events
    high = max(minute(r["at"]) for r in events)
    at = {(r["series"], minute(r["at"]), r["change"]) for r in events}
    assert len(at) == len(events)
    for series in ("a", "b", None):
        holding = False
        for instant in range(0, high + 1, 10):
            total = sum(v for s, v, t in points if s == series and instant - 30 <= minute(t) < instant)
            now = total > 9
            assert ((series, instant, "ENTER") in at) == (now and not holding)
            assert ((series, instant, "LEAVE") in at) == (holding and not now)
            holding = now
