"""Interval joins against every pair, and merged sketches against exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import interval_join as ij
from lakeops.operators.sketches import append_sketches, distinct_sketches, estimates, roll_up

SCHEMA = "id int, k string, low bigint, high bigint"


def intervals(rng, n, top):
    rows = []
    for i in range(n):
        low = rng.choice([None, 0, -5, rng.randrange(-top, top)])
        length = rng.choice([0, 1, 1, 7, 8, 9, 63, 64, 65, rng.randrange(1, top), -3])
        rows.append((i, rng.choice([None, "a", "b"]), low, rng.choice([None] + [None if low is None else low + length] * 12)))
    return rows


def pairs_plainly(left, right, keyed):
    return sorted((a[0], b[0]) for a in left for b in right
                  if None not in (a[2], a[3], b[2], b[3]) and a[2] < a[3] and b[2] < b[3] and a[2] < b[3] and b[2] < a[3]
                  and (not keyed or (a[1] is not None and a[1] == b[1])))


def pairs(df):
    return sorted((r[0], r[1]) for r in df.select("left.id", "right.id").collect())


@pytest.mark.parametrize("keyed, hot", [(False, 50_000), (True, 50_000), (False, 3), (True, 2)])
def test_every_overlapping_pair_once(spark, monkeypatch, keyed, hot):
    monkeypatch.setattr(ij, "HOT", hot)
    rng = random.Random(hot)
    left, right = intervals(rng, 70, 300), intervals(rng, 60, 5_000)
    joined = ij.interval_join(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA),
                              ("low", "high"), ("low", "high"), ["k"] if keyed else [])
    assert pairs(joined) == pairs_plainly(left, right, keyed)


def test_plan_has_no_nested_loop(spark):
    rows = spark.range(100).selectExpr("cast(id as int) as id", "id as low", "id + 5 as high")
    joined = ij.interval_join(rows, rows, ("low", "high"), ("low", "high"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.count() == 100 + 2 * (99 + 98 + 97 + 96)


@pytest.mark.parametrize("per", [None, (["id"], [])])
def test_plan_broadcasts_no_side_that_was_spread(spark, folder, per):
    # small files, of which a row becomes many
    spark.range(1_000).selectExpr("id", "id * 1000 as low", "id * 1000 + 1000000 as high").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    joined = ij.interval_join(rows, rows, ("low", "high"), ("low", "high"), per=per)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    joined.collect()
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keyed", [False, True])
def test_sums_over_pairs_without_pairs(spark, keyed):
    rng, on = random.Random(5), ["k"] if keyed else []
    left, right = intervals(rng, 80, 300), intervals(rng, 70, 5_000)
    sides = [spark.createDataFrame(rows, SCHEMA).selectExpr("*", "if(id % 5 = 0, null, id - 20) as x", f"if(id % 4 = 1, null, id % 3) as {g}")
             for rows, g in ((left, "g"), (right, "h"))]
    summed = ij.interval_join(*sides, ("low", "high"), ("low", "high"), on, per=(["g"], ["h"]), count="pairs",
                              sums={"l": "left.x", "r": "right.x"})
    made = ij.interval_join(*sides, ("low", "high"), ("low", "high"), on).groupBy("left.g", "right.h").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("left.x").alias("l"), F.sum("right.x").alias("r"))
    rows = sorted(map(str, summed.collect()))
    assert rows and rows == sorted(map(str, made.collect())) and summed.columns == made.columns
    assert sum(r["pairs"] for r in summed.collect()) == len(pairs_plainly(left, right, keyed))


def test_sums_over_many_pairs(spark):
    # 4 * 10 ** 8 pairs, half of them at one instant
    rows = spark.range(20_000).selectExpr("id", "if(id % 2 = 0, 0L, id) as low", "50000L as high")
    total = ij.interval_join(rows, rows, ("low", "high"), ("low", "high"), per=([], []), sums={"ids": "right.id"}).first()
    assert total["n"] == 20_000 ** 2 and total["ids"] == 20_000 * sum(range(20_000))


def test_timestamps_dates_and_nothing(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-10')) AS low").withColumn("high", F.date_add("low", 3))
    assert ij.interval_join(days, days, ("low", "high"), ("low", "high")).count() == 10 + 2 * (9 + 8)
    hours = days.select(F.col("low").cast("timestamp").alias("low"), F.col("high").cast("timestamp").alias("high"))
    assert ij.interval_join(hours, hours, ("low", "high"), ("low", "high")).count() == 10 + 2 * (9 + 8)
    assert ij.interval_join(hours.limit(0), hours, ("low", "high"), ("low", "high")).count() == 0
    assert ij.interval_join(hours.limit(0), hours.limit(0), ("low", "high"), ("low", "high")).columns == ["left", "right"]
    with pytest.raises(TypeError):
        ij.interval_join(days.select(F.lit("a").alias("low"), "high"), days, ("low", "high"), ("low", "high"))


def test_sketches_roll_up_within_two_percent(spark):
    rows = spark.range(60_000).selectExpr("id % 20 as day", "case when id % 3 = 0 then 'hot' end as kind", "pmod(id * 7919, 23000) as user")
    daily = distinct_sketches(rows, {"day": "day", "kind": "kind"}, "user")
    total = {r["kind"]: (r["users"], r["rows"]) for r in estimates(roll_up(daily, {"kind": "kind"}), "users").collect()}
    exact = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count_distinct("user").alias("n")).collect()}
    assert all(abs(total[k][0] - n) <= 0.02 * n for k, n in exact.items()) and total["hot"][1] == 20_000
    halves = append_sketches(distinct_sketches(rows.where("user < 9000"), {"day": "day", "kind": "kind"}, "user"),
                             distinct_sketches(rows.where("user >= 9000"), {"day": "day", "kind": "kind"}, "user"))
    same = lambda df: sorted(map(str, estimates(df, "users").collect()))
    assert same(halves) == same(daily)
