import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeops.operators import partitions as parts
from lakeops.operators.export import extract
from lakeops.operators.lifecycle import LifecycleRule, lifecycle
from lakeops.operators.tables import (check_table_name, copy_tables, create_table, expire, table_metadata,
                                      table_property, write_table)
from lakeops.operators.views import FileFunction, MaterializedView, create_view
from lakeops.session import fresh_database

# five moments a step apart around the leap day of 2016, the bounds being the second and the fourth
MIDDLE = dt.datetime(2016, 2, 29, 21, 17)
DATES = {
    "HOUR": [MIDDLE + dt.timedelta(hours=i) for i in range(-2, 3)],
    "DAY": [MIDDLE + dt.timedelta(days=i) for i in range(-2, 3)],
    "MONTH": [dt.datetime(2015 + m // 12, m % 12 + 1, 28) for m in range(10, 15)],
    "YEAR": [MIDDLE.replace(year=2016 + 4 * i) for i in range(-2, 3)]}
FLOOR = {"HOUR": "%Y-%m-%dT%H:00:00", "DAY": "%Y-%m-%dT00:00:00", "MONTH": "%Y-%m-01T00:00:00", "YEAR": "%Y-01-01T00:00:00"}
BOUNDS = {kind: (DATES[kind][1].strftime(f), DATES[kind][3].strftime(f)) for kind, f in FLOOR.items()} | {"RANGE": ("2", "4")}


@pytest.fixture
def database(spark):
    return fresh_database(spark, "t")


def transactions(spark, kind):
    rows = spark.createDataFrame(list(enumerate(DATES.get(kind, DATES["DAY"]), 1)), "id bigint, at timestamp_ntz")
    if kind == "RANGE":
        return parts.partition_by_range(rows, "id", 0, 100, 1)
    return parts.partition_by_time(rows, "at", kind)


@pytest.mark.parametrize("kind", BOUNDS)
def test_partitions_deleted(spark, database, kind):
    write_table(transactions(spark, kind), f"{database}.t", partitioned=True)
    gone = parts.delete_partitions(spark, f"{database}.t", kind, *BOUNDS[kind])
    assert len(gone) == 3 and spark.table(f"{database}.t").count() == 2
    with pytest.raises(Exception, match="(?i)partition"):
        parts.drop_partitions(spark, f"{database}.t", gone[:1])


def test_partitions_copied(spark, database):
    write_table(transactions(spark, "DAY"), f"{database}.t", partitioned=True)
    assert len(parts.copy_partitions(spark, f"{database}.t", f"{database}.c", "DAY", *BOUNDS["DAY"])) == 3
    assert spark.table(f"{database}.c").count() == 3
    none = ("2031-01-01T00:00:00", "2031-02-01T00:00:00")
    assert parts.copy_partitions(spark, f"{database}.t", f"{database}.n", "DAY", *none, skip_empty=True) == []
    with pytest.raises(parts.NoPartitionsError):
        parts.copy_partitions(spark, f"{database}.t", f"{database}.n", "DAY", *none)


def test_dispositions(spark, database):
    name = f"{database}.t"
    with pytest.raises(ValueError, match="does not exist"):
        write_table(spark.range(3), name, create="CREATE_NEVER")
    write_table(spark.range(3), name, write="WRITE_EMPTY")
    with pytest.raises(ValueError, match="already holds"):
        write_table(spark.range(3), name, write="WRITE_EMPTY")
    with pytest.raises(ValueError, match="has no fields"):
        write_table(spark.range(3).withColumn("x", F.lit(1)), name)
    with pytest.raises(ValueError, match="append or truncate"):
        write_table(spark.range(3), name, write="WRITE_EMPTY", schema_update=["ALLOW_FIELD_ADDITION"])
    write_table(spark.range(5), name, write="WRITE_TRUNCATE")
    assert spark.table(name).count() == 5
    for bad in ("t", "a.b.c.d", "a."):
        with pytest.raises(ValueError):
            check_table_name(bad)


def test_append_with_added_field_in_a_partitioned_table(spark, database):
    name = f"{database}.t"
    rows = spark.range(25).select("id", F.lit("20160229").alias(parts.PARTITION))
    write_table(rows, name, partitioned=True, cluster_by=["id"])
    write_table(rows.withColumn("counter", F.col("id") * 2), name, partitioned=True,
                schema_update=["ALLOW_FIELD_ADDITION"])
    got = spark.table(name)
    assert got.count() == 50 and got.where("counter is null").count() == 25
    assert got.where("counter = id * 2").count() == 25


def test_required_fields_and_relaxation(spark, database):
    name = f"{database}.t"
    create_table(spark, name, {"schema": {"fields": [
        {"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "STRING"}]}})
    hole = spark.sql("select cast(null as bigint) as a, 'x' as b")
    with pytest.raises(Exception, match="a is required"):
        write_table(hole, name)
    write_table(hole, name, schema_update=["ALLOW_FIELD_RELAXATION"])
    assert spark.table(name).count() == 1


def test_clustered_files_do_not_overlap(spark, database, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(spark.range(10000).withColumn("k", F.col("id") * 7919 % 10007), f"{database}.t", cluster_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted({r[0][7:] for r in spark.table(f"{database}.t").select(F.input_file_name()).collect()})
    bounds = []
    for path in files:
        column = next(c for c in range(2) if pq.ParquetFile(path).schema.column(c).name == "k")
        stats = pq.ParquetFile(path).metadata.row_group(0).column(column).statistics
        bounds.append((stats.min, stats.max))
    bounds.sort()
    assert len(bounds) > 4 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_metadata_of_defined_table(spark, database):
    name = f"{database}.t"
    create_table(spark, name, {
        "schema": {"fields": [{"name": "bird", "type": "STRING"}, {"name": "wingspan", "type": "INT64"},
                              {"name": "seen", "type": "TIMESTAMP"}]},
        "partitioned": True, "clustering": ["wingspan"], "labels": {"env": "dev"}, "description": "it's stock",
        "expires_ms": 99})
    row = table_metadata(spark, name).first()
    assert row["partitioned"] and row["num_rows"] == 0 and row["description"] == "it's stock"
    assert table_property(spark, name, "label.env") == "dev"
    assert table_metadata(spark, f"{database}.none", "SKIP") is None
    with pytest.raises(ValueError):
        table_metadata(spark, f"{database}.none")
    assert expire(spark, database, now_ms=98)["tables"] == []
    assert expire(spark, database, now_ms=99)["tables"] == [name]
    assert not spark.catalog.tableExists(name)


def test_expired_partitions(spark, database):
    name = f"{database}.t"
    write_table(transactions(spark, "DAY"), name, partitioned=True)
    now = int(dt.datetime(2016, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert expire(spark, database, now, default_ttl_ms=86_400_000)["partitions"] == [
        f"{name}$20160227", f"{name}$20160228"]


def test_copies(spark, database):
    for n in ("a", "b"):
        write_table(spark.range(2), f"{database}.{n}")
    copy_tables(spark, [f"{database}.a", f"{database}.b"], f"{database}.c")
    assert spark.table(f"{database}.c").count() == 4
    with pytest.raises(ValueError):
        copy_tables(spark, [f"{database}.a"], f"{database}.c")


def test_extracted_csv_text(spark, folder):
    one = spark.sql("select 'grey heron' as bird, 185L as wingspan")
    counts = extract(one, f"{folder}/out/*", "csv").first()
    (path,) = glob.glob(f"{folder}/out/part-*.csv")
    assert open(path).read() == "bird,wingspan\ngrey heron,185\n"
    assert counts["files"] == 1 and counts["bytes"] == 29
    with pytest.raises(RuntimeError, match="spark-avro"):
        extract(one, f"{folder}/avro", "avro")


def test_several_targets_share_rows(spark, folder):
    extract(spark.range(1000), [f"{folder}/a/*", f"{folder}/b/*"], "parquet")
    a, b = spark.read.parquet(f"{folder}/a"), spark.read.parquet(f"{folder}/b")
    assert a.count() and b.count() and a.union(b).distinct().count() == 1000 == a.count() + b.count()


def test_view_over_function_file(spark, folder):
    with open(f"{folder}/shout_functions.py", "w") as out:
        out.write("def shout(text):\n    return text.upper() + '!'\n")
    import sys
    sys.path.insert(0, folder)
    create_view(spark, "shouts", "SELECT shout('hi') AS s", [FileFunction(f"{folder}/shout_functions.py", "shout_functions", "shout")])
    assert spark.table("shouts").first()[0] == "HI!"


def test_materialized_view_modes(spark, folder):
    base = f"{folder}/base"
    put = lambda n, mode="append": spark.range(n).withColumn("v", F.col("id") % 2).write.mode(mode).parquet(base)
    put(10)
    view = MaterializedView(spark, f"{folder}/view", base, {"v": "v"}, {"n": "1"}, min_interval_ms=100)
    assert view.refresh(0) == "full" and view.refresh(50) == "too_soon" and view.refresh(200) == "unchanged"
    put(4)
    assert view.refresh(300) == "incremental"
    assert sorted(map(tuple, view.read().collect())) == [(0, 7), (1, 7)]
    put(6, "overwrite")
    assert view.refresh(500) == "full"
    assert sorted(map(tuple, view.read().collect())) == [(0, 3), (1, 3)]
    view.enable_refresh = False
    assert view.refresh(900) == "disabled"


def test_lifecycle_precedence(spark):
    objects = spark.sql("select explode(array(timestamp'2024-01-01', timestamp'2024-01-20', timestamp'2024-01-30 12:00:00')) as created")
    rules = [LifecycleRule(30, "DELETE"), LifecycleRule(1, "SET_STORAGE_CLASS", "NEARLINE"),
             LifecycleRule(5, "SET_STORAGE_CLASS", "ARCHIVE")]
    got = lifecycle(objects, rules, F.to_timestamp(F.lit("2024-01-31"))).orderBy("created").collect()
    assert [(r["due"], r["target_class"]) for r in got] == [("DELETE", None), ("SET_STORAGE_CLASS", "ARCHIVE"), (None, None)]
    with pytest.raises(ValueError):
        LifecycleRule(1, "SET_STORAGE_CLASS", "LUKEWARM")


def test_nested_fields_are_added_and_relaxed(spark, database):
    """In a struct, in an array of structs, and one level deeper; rows written before read as null there."""
    name = f"{database}.nested"
    inner = [{"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "deep", "type": "RECORD", "fields": [{"name": "x", "type": "INT64"}]}]
    create_table(spark, name, {"schema": {"fields": [
        {"name": "id", "type": "INT64"}, {"name": "s", "type": "RECORD", "fields": inner},
        {"name": "items", "type": "RECORD", "mode": "REPEATED", "fields": inner}]}})
    assert table_property(spark, name, "lakeops.required") == "s.a,items[].a"
    old = "named_struct('a', id, 'deep', named_struct('x', id))"
    write_table(spark.range(2).selectExpr("id", f"{old} as s", f"array({old}) as items"), name)
    lacking = spark.range(2, 3).selectExpr("id", "named_struct('deep', named_struct('x', id), 'a', cast(null as bigint)) as s", f"array({old}) as items")
    with pytest.raises(Exception, match="s.a is required"):
        write_table(lacking, name)
    with pytest.raises(ValueError, match="s.deep.y"):
        write_table(spark.range(1).selectExpr("id", "named_struct('deep', named_struct('y', 'new')) as s"), name)
    assert spark.table(name).count() == 2
    new = "named_struct('deep', named_struct('y', concat('n', id), 'x', id), 'b', true, 'a', id)"
    write_table(spark.range(3, 4).selectExpr("id", f"{new} as s", f"array({new}, null) as items"), name, schema_update=["ALLOW_FIELD_ADDITION"])
    assert spark.table(name).schema["s"].dataType.simpleString() == "struct<a:bigint,deep:struct<x:bigint,y:string>,b:boolean>"
    rows = {r["id"]: r for r in spark.table(name).collect()}
    assert rows[0]["s"].asDict(True) == {"a": 0, "deep": {"x": 0, "y": None}, "b": None} == rows[0]["items"][0].asDict(True)
    assert rows[3]["s"].asDict(True) == {"a": 3, "deep": {"x": 3, "y": "n3"}, "b": True}
    assert rows[3]["items"][0].asDict(True) == {"a": 3, "deep": {"x": 3, "y": "n3"}, "b": True} and rows[3]["items"][1] is None
    write_table(lacking, name, schema_update=["ALLOW_FIELD_RELAXATION"])
    assert table_property(spark, name, "lakeops.required") == "items[].a"
    write_table(lacking.withColumn("id", F.lit(9)), name)
    assert spark.table(name).where("s.a is null").count() == 2
