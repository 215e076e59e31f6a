import pytest
from pyspark.sql import functions as F

from lakeops.operators.sql import as_script, bind_parameters, flatten, named_parameters, next_page, query_statistics, run_observed, run_sql
from lakeops.session import fresh_database


def test_parameter_guards():
    for bad in ([], [1, None], [1, "a"]):
        with pytest.raises(ValueError):
            bind_parameters({"p": bad})
    assert bind_parameters({"p": {"a": 1}}) == {"p": '{"a": 1}'}


def test_rewriting_leaves_quotes_alone():
    text = "SELECT '@a', \"@b\", `@c`, @d -- @e\n, f@g FROM t WHERE t.id IN UNNEST(@ids) AND x NOT IN UNNEST (@no)"
    assert named_parameters(text) == (
        "SELECT '@a', \"@b\", `@c`, :d -- @e\n, f@g FROM t WHERE array_contains(:ids, t.id) AND NOT array_contains(:no, x)")


def test_scripts_are_wrapped():
    assert as_script("select ';' as a;") == "select ';' as a"
    assert as_script("select 1; select 2").startswith("BEGIN")


def test_parameters_of_all_kinds(spark):
    import datetime as dt
    import decimal
    row = run_sql(spark, "SELECT @b AS b, @n AS n, @d AS d, @t AS t, @x AS x, @l AS l, @j AS j", params={
        "b": True, "n": decimal.Decimal("123.45"), "d": dt.date(2026, 6, 24),
        "t": dt.datetime(2026, 6, 24, 12), "x": b"\x01\x02\x03", "l": ["a", "b"], "j": {"key": "value"}}).rows.first()
    assert row["b"] is True and row["n"] == decimal.Decimal("123.45") and row["d"] == dt.date(2026, 6, 24)
    assert bytes(row["x"]) == b"\x01\x02\x03" and row["l"] == ["a", "b"] and row["j"] == '{"key": "value"}'


def test_result_modes(spark):
    text = "SELECT id FROM range(10)"
    assert run_sql(spark, text).rows.count() == 10
    assert run_sql(spark, text, "FETCH_ONE").size == 1
    assert run_sql(spark, text + " WHERE id > 99", "FETCH_ONE").size == 0
    stored = run_sql(spark, text, "STORE")
    assert stored.size == 10 and spark.read.parquet(stored.uri).count() == 10
    with pytest.raises(ValueError):
        run_sql(spark, text, "SOME")


def test_default_dataset_does_not_leak(spark):
    database = fresh_database(spark, "leak")
    run_sql(spark, "CREATE TABLE t USING parquet AS SELECT 1 AS a; SELECT * FROM t", default_dataset=database)
    assert spark.catalog.currentDatabase() == "default"
    assert spark.table(f"{database}.t").count() == 1


def test_large_fetch(spark):
    assert run_sql(spark, "SELECT id FROM range(100000)").rows.count() == 100_000


def test_flatten(spark):
    nested = spark.sql("select 1 as a, named_struct('b', 2, 'c', array(named_struct('d', 3), named_struct('d', 4))) as s")
    assert sorted(map(tuple, flatten(nested).collect())) == [(1, 2, 3), (1, 2, 4)]
    empty = spark.sql("select 1 as a, cast(array() as array<int>) as b")
    assert [tuple(r) for r in flatten(empty).collect()] == [(1, None)]
    with pytest.raises(ValueError, match="sibling"):
        flatten(spark.sql("select array(1) as a, array(2) as b"))


def test_keyset_pages_cover_everything(spark):
    rows, seen, last = spark.range(25), [], None
    while got := [r[0] for r in next_page(rows, "id", 10, last).collect()]:
        seen += got
        last = got[-1]
    assert seen == list(range(25))
    assert rows.where(F.col("id") < 0).count() == 0


def test_statistics_count_pruned_files(spark, folder):
    spark.range(100).withColumn("p", F.col("id") % 4).repartition("p").write.partitionBy("p").parquet(f"{folder}/t")
    scan = spark.read.parquet(f"{folder}/t").where("p = 1")
    row = query_statistics(scan, "p", "quarter", scan, dml_rows=3).first()
    assert (row["rows"], row["partitions"], row["input_files"], row["dml_rows"], row["label"]) == (25, 1, 1, 3, "quarter")
    assert row["input_bytes"] > 0
    assert run_sql(spark, "SELECT 1 AS a").size == 1


def test_destination_layout_views_and_database(spark):
    database = fresh_database(spark, "layout")
    spark.range(3).createOrReplaceTempView("kept_view")
    before, zone = spark.catalog.currentDatabase(), spark.conf.get("spark.sql.session.timeZone")
    rows = "SELECT id, timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id AS INT)) AS at FROM kept_view"
    out = run_sql(spark, rows, destination=f"{database}.t", partition_column="at", cluster_by=["id"], default_dataset=database)
    assert out.size == 3 and {r["partition_id"] for r in out.rows.collect()} == {"20240101", "20240102", "20240103"}
    more = run_sql(spark, rows.replace(" FROM", ", 1 AS extra FROM"), destination=f"{database}.t", write="WRITE_APPEND",
                   partition_column="at", schema_update=["ALLOW_FIELD_ADDITION"])
    assert more.rows.where("extra = 1").count() == 3 and more.rows.count() == 6
    again = run_sql(spark, f"SELECT * FROM {database}.t WHERE id > 0", destination=f"{database}.t", write="WRITE_TRUNCATE")
    assert again.rows.count() == 4
    with pytest.raises(Exception):
        run_sql(spark, f"SELECT id, at, extra, partition_id FROM {database}.t WHERE raise_error('no') = 1",
                destination=f"{database}.t", write="WRITE_TRUNCATE")
    assert spark.table(f"{database}.t").count() == 4
    assert (before, zone) == (spark.catalog.currentDatabase(), spark.conf.get("spark.sql.session.timeZone"))


def test_observed_run_evaluates_its_plan_once(spark, folder):
    touched = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            touched.add(len(batch))
            yield batch

    df = spark.range(100).withColumn("p", F.col("id") % 4).mapInPandas(count, "id bigint, p bigint").where("id >= 10")
    rows, stats = run_observed(df, f"{folder}/out", partition_column="p", label="x", changed=F.col("id") < 15)
    assert touched.value == 100
    assert (stats.rows, stats.partitions, stats.dml_rows, stats.label) == (90, 4, 5, "x")
    assert stats.bytes > 0 and stats.files > 0 and stats.seconds > 0 and rows.count() == 90
    empty = run_observed(df.where("id < 0"), f"{folder}/none", partition_column="p")[1]
    assert (empty.rows, empty.partitions, empty.dml_rows) == (0, 0, None)
    assert stats.frame(spark).first()["rows"] == 90


def test_cube_over_distinct_keys_groups_small_parts(spark, tmp_path, monkeypatch):
    """Equal orders stand in one part, parts grow in number with the rows, and null orders and flags count as in SQL."""
    from lakeops.plans import sql_queries
    monkeypatch.setattr(sql_queries, "PART_ROWS", 100, raising=False)
    rows = [(i % 333 if i % 50 else None, "ANR"[i % 3] if i % 7 else None, "FO"[i % 2]) for i in range(2000)]
    lines = spark.createDataFrame(rows, "l_orderkey bigint, l_returnflag string, l_linestatus string")
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    result = sql_queries.sql_cube_distinct(spark, str(tmp_path)).collect()
    parts = spark.table("lineitem").withColumn("part", F.spark_partition_id())
    assert parts.select("part").distinct().count() > 10
    assert parts.groupBy("l_orderkey").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0
    expected = set()
    for flags in ({f for _, f, _ in rows}, None):
        for states in ({s for _, _, s in rows}, None):
            for f in flags or {"all"}:
                for s in states or {"all"}:
                    own = [k for k, flag, state in rows if (flags is None or flag == f) and (states is None or state == s)]
                    expected.add((f, s, len(set(own) - {None}), len(own), flags is None, states is None))
    assert sorted((r["l_returnflag"] or "", r["l_linestatus"] or "", r["orders"], r["n"]) for r in result) == sorted(
        ("" if all_flags else f or "", "" if all_states else s, orders, n) for f, s, orders, n, all_flags, all_states in expected)
