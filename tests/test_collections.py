"""Stored document collections, far pages, external tables with a budget, destinations and lifetimes."""

import json

import pytest
from pyspark.sql import functions as F

from lakeops.operators.docs import DocCollection
from lakeops.operators.sql import run_sql
from lakeops.operators.tables import create_table, expire, set_default_lifetime, table_property
from lakeops.session import fresh_database, list_names
from lakeops.sources import docs as doc_sources
from lakeops.sources.load import create_external_table


def contents(collection):
    return {r["doc_id"]: json.loads(r["data"]) for r in collection.read().collect()}


def test_collection_is_stored_and_only_touched_buckets_are_rewritten(spark, folder):
    path = f"{folder}/notes"
    collection = DocCollection(spark, path, buckets=8)
    assert contents(collection) == {}
    docs = spark.range(40).selectExpr("cast(id as string) as doc_id", "to_json(struct(id as n)) as data")
    assert collection.set(docs) == 40
    again = DocCollection(spark, path, buckets=99)
    assert again.buckets == 8 and contents(again) == {str(i): {"n": i} for i in range(40)}

    def files():
        return {n: list_names(spark, f"{path}/{n}") for n in list_names(spark, path, dirs_only=True) if n.startswith("bucket=")}

    before = files()
    assert again.set(spark.createDataFrame([("7", None), ("new", '{"n": -1}')], "doc_id string, data string")) == 2
    changed = [n for n, names in files().items() if names != before.get(n)]
    assert 1 <= len(changed) <= 2
    expected = {str(i): {"n": i} for i in range(40)} | {"7": {}, "new": {"n": -1}}
    assert contents(again) == expected
    assert again.delete(["3", "missing"]) == 1
    assert again.delete(spark.createDataFrame([("4",), ("4",)], "doc_id string")) == 1
    assert contents(again) == {k: v for k, v in expected.items() if k not in ("3", "4")}
    everything = again.read().select("doc_id")
    assert again.delete(everything) == 39 and contents(again) == {}


def test_collection_generates_ids_and_refuses_doubles(spark, folder):
    collection = DocCollection(spark, f"{folder}/c", buckets=4)
    assert collection.set(spark.createDataFrame([({"a": "x"},), (None,)], "data map<string,string>")) == 2
    assert sorted(map(str, contents(collection).values())) == ["{'a': 'x'}", "{}"]
    with pytest.raises(ValueError):
        collection.set(spark.createDataFrame([("a", "{}"), ("a", "{}")], "doc_id string, data string"))
    assert collection.set(spark.createDataFrame([("a", "{}", 1), ("a", '{"b":1}', 2)], "doc_id string, data string, seq int")) == 1
    assert contents(collection)["a"] == {"b": 1}


@pytest.mark.parametrize("direction", ["ASCENDING", "DESCENDING"])
def test_far_pages_are_those_of_near_ones(spark, monkeypatch, direction):
    docs = spark.range(60).selectExpr("lpad(id, 3, '0') as doc_id", "to_json(struct(id % 7 as n)) as data")
    pages = [("n", 10, 5), ("n", 50, None), (None, 55, 50), ("n", 100, 1)]

    def ask():
        return [[r["doc_id"] for r in doc_sources.doc_query(docs, order_by=o, direction=direction, offset=off, limit=n, types={"n": "int"}).collect()]
                for o, off, n in pages]

    near = ask()
    monkeypatch.setattr(doc_sources, "MAX_PAGE_END", 0)
    assert ask() == near and [len(x) for x in near] == [5, 10, 5, 0]


def test_external_table_with_budget_and_detected_schema(spark, folder):
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": "no"}',), ("{broken",), ('{"a": 3}',)], "v string").coalesce(1).write.text(f"{folder}/j")
    schema = {"fields": [{"name": "a", "type": "INT64"}, {"name": "b", "type": "STRING"}]}
    create_external_table(spark, "within", f"{folder}/j", "json", schema, max_bad_records=2)
    assert sorted(r["a"] for r in spark.table("within").collect()) == [1, 3]
    create_external_table(spark, "beyond", f"{folder}/j", "json", schema, max_bad_records=1)
    with pytest.raises(Exception, match="more than 1 bad records: 2"):
        spark.table("beyond").collect()
    spark.createDataFrame([(1, "x", 2.5)], "id int, name string, v double").write.option("header", True).csv(f"{folder}/c")
    from lakeops.sources.load import CsvOptions
    create_external_table(spark, "found", f"{folder}/c", "csv", csv=CsvOptions(skip_leading_rows=1), autodetect=True, max_bad_records=0)
    assert spark.table("found").dtypes == [("id", "int"), ("name", "string"), ("v", "double")] and spark.table("found").count() == 1
    with pytest.raises(ValueError):
        create_external_table(spark, "none", f"{folder}/c", "csv")


def test_destination_in_ranges_and_default_lifetime(spark):
    database = fresh_database(spark, "ranges")
    out = run_sql(spark, "SELECT id, id * 2 AS v FROM range(25)", destination=f"{database}.t", partition_column="id", partition_range=(0, 20, 10))
    ids = {r["partition_id"]: r["n"] for r in out.rows.groupBy("partition_id").agg(F.count("*").alias("n")).collect()}
    assert ids == {"0": 10, "10": 10, "__UNPARTITIONED__": 5}
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1 AS id", destination=f"{database}.u", partition_range=(0, 2, 1))
    set_default_lifetime(spark, database, 1_000)
    run_sql(spark, "SELECT 1 AS a", destination=f"{database}.short")
    create_table(spark, f"{database}.own", {"schema": {"fields": [{"name": "a", "type": "INT64"}]}, "expires_ms": 9_999_999_999_999})
    create_table(spark, f"{database}.made", {"schema": {"fields": [{"name": "a", "type": "INT64"}]}})
    due = int(table_property(spark, f"{database}.short", "lakeops.expires_ms"))
    assert expire(spark, database, due - 1_000)["tables"] == []
    gone = expire(spark, database, due + 60_000)["tables"]
    assert sorted(gone) == [f"{database}.made", f"{database}.short"]
    assert spark.catalog.tableExists(f"{database}.t") and spark.catalog.tableExists(f"{database}.own")
