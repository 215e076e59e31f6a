"""One key holds a third of all rows or more; results must stay whole."""

import random

from pyspark.sql import functions as F

from lakeops.operators.skew import cluster_evenly, nest_groups, newest_within_budget, number_rows, rank_evenly


def hot(spark, rows=3000):
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))


def test_long_groups_come_in_parts(spark):
    nested = nest_groups(hot(spark), ["k"], ["v"], ["v"], "vs", max_items=100).collect()
    parts = [r for r in nested if r["k"] == 0]
    assert len(parts) > 5
    assert sorted(e["v"] for r in nested for e in r["vs"]) == list(range(3000))
    assert all([e["v"] for e in r["vs"]] == sorted(e["v"] for e in r["vs"]) for r in nested)
    assert max(len(r["vs"]) for r in parts) < 400


def test_copies_in_a_long_group_spread(spark):
    copies = spark.range(2000).select(F.lit(1).alias("k"), F.lit(7).alias("v"))
    nested = nest_groups(copies, ["k"], ["v"], ["v"], "vs", max_items=100).collect()
    assert len(nested) == 20 and sum(len(r["vs"]) for r in nested) == 2000
    assert max(len(r["vs"]) for r in nested) < 300


def test_copies_of_one_row_spread_when_clustered(spark):
    df = spark.range(1_500_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("c"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = rank_evenly(df, ["c"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 1_500_000
    assert max(r["count"] for r in sizes) < 400_000


def test_budget_matches_brute_force(spark):
    random.seed(1)
    turns = [(0, t, random.randint(0, 9)) for t in range(5000)] + [
        (c, t, random.randint(0, 9)) for c in range(1, 50) for t in range(random.randint(1, 40))]
    df = spark.createDataFrame(turns, "c bigint, t bigint, n bigint")
    for budget, block in ((0, 16), (60, 16), (3000, 64), (10**9, 64)):
        expected = set()
        for conversation in range(50):
            used = 0
            for c, t, n in sorted((x for x in turns if x[0] == conversation), key=lambda x: -x[1]):
                used += n
                if used <= budget:
                    expected.add((c, t, n))
        got = newest_within_budget(df, ["c"], "t", F.col("n"), budget, block).collect()
        assert set(map(tuple, got)) == expected and len(got) == len(expected)


def test_rows_of_one_position_count_together(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 1, 5), (None, 0, 1), (1, 0, 3)], "c bigint, t bigint, n bigint")
    keep = lambda budget: sorted(map(str, newest_within_budget(df, ["c"], "t", F.col("n"), budget).select("t", "n").collect()))
    assert len(keep(9)) == 1 and len(keep(10)) == 3 and len(keep(11)) == 4


def test_row_numbers_have_no_gaps(spark):
    df = hot(spark, 2000).withColumn("h", F.xxhash64("v"))
    got = number_rows(df, ["k", "h"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(2000))
    assert [(r["k"], r["h"]) for r in got] == sorted((r["k"], r["h"]) for r in got)


def test_equal_cluster_values_spread(spark):
    df = spark.range(20000).select(F.lit(1).alias("c"), "id")
    # small results are merged at run time, which is right but hides the split
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = rank_evenly(df, ["c"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and sum(r["count"] for r in sizes) == 20000


def test_parts_joined_in_order_are_the_one_list(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "x").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.expr("cast(pmod(hash(id), 50) as int)").alias("v"))
    whole = {r["k"]: [i["v"] for i in r["vs"]] for r in nest_groups(rows, ["k"], ["v"], ["v"], "vs").collect()}
    parts = nest_groups(rows, ["k"], ["v"], ["v"], "vs", max_items=100).collect()
    joined = {}
    for r in sorted(parts, key=lambda r: r["part"]):
        assert len(r["vs"]) <= 100
        joined.setdefault(r["k"], []).extend(i["v"] for i in r["vs"])
    assert joined == whole and sum(r["k"] is None for r in parts) == 10


def test_any_clustered_column_prunes_files(spark, folder):
    """Two numbers, a text and a date that have nothing to do with each other."""
    rows = spark.range(40_000).selectExpr(
        "pmod(id * 7919, 10007) as a", "cast(pmod(id * 104729, 9973) as double) as b",
        "concat('k', lpad(pmod(id * 1299709, 9001), 5, '0')) as c", "case when id % 3 = 0 then 5 else id end as hot")
    for columns in (["a", "b", "c"], ["hot", "b"]):
        path = f"{folder}/{columns[0]}"
        cluster_evenly(rows, columns).write.option("maxRecordsPerFile", 400).parquet(path)
        stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
        assert sorted(map(tuple, stored.select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
        ends = stored.groupBy("file").agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]).collect()
        for column, value in (("a", 5_000), ("b", 5_000.0), ("c", "k04500"), ("hot", 20_002)):
            if column in columns:
                read = sum(1 for r in ends if r[f"low_{column}"] <= value <= r[f"high_{column}"])
                assert read < len(ends) / 3, (column, read, len(ends))


def test_layouts_evaluate_their_input_once(spark):
    touched = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            touched.add(len(batch))
            yield batch

    rows = spark.range(1_000).withColumn("b", F.col("id") % 7).mapInPandas(count, "id bigint, b bigint")
    assert rank_evenly(rows, ["id"]).count() == 1_000 and cluster_evenly(rows, ["id", "b"]).count() == 1_000
    assert touched.value == 2_000
    assert cluster_evenly(rows.limit(0), ["id", "b"]).count() == 0
