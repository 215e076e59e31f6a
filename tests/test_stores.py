import pytest
from pyspark.sql import functions as F

from lakeops.operators import docs as doc_ops
from lakeops.operators import text
from lakeops.operators.versioned import VersionedTable
from lakeops.operators.widecol import apply_mutations, delete_rows, remaining_cells, write_cells
from lakeops.operators.docs import doc_set
from lakeops.sources import docs, widecol
from lakeops.sources.objects import list_objects, scan_folder
from lakeops.sources.series import query_series
from lakeops.sources.widecol import read_cells
from lakeops.streaming.watch import push_points, watch_cells

CELLS = "row_key string, family string, qualifier string, value string, timestamp bigint"
MUTATIONS = "row_key string, family string, cells map<string,string>, delete_cells array<string>, seq int"


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([
        ("row-001", "cf1", "value", "41", 1), ("row-001", "cf1", "value", "42", 2),
        ("row-001", "meta", "m", "x", 2), ("row-002", "meta", "m", "y", 3), ("row-1", "cf1", "value", "z", 9)], CELLS)


def test_wide_reads(cells):
    keys = lambda **how: sorted({r[0] for r in widecol.read_cells(cells, **how).collect()})
    assert keys(prefix="row-00") == ["row-001", "row-002"]
    assert keys(start="row-001", end="row-002") == ["row-001"]
    assert keys(family="cf1") == ["row-001", "row-1"]
    assert keys(mode="FETCH_ONE", prefix="row-00") == ["row-001"]
    assert keys(limit=2) == ["row-001", "row-002"]
    nested = widecol.read_rows(cells, prefix="row-001").first()
    assert [(c["qualifier"], c["value"]) for c in nested["cells"]] == [("value", "41"), ("value", "42"), ("m", "x")]
    assert widecol.newest_cells(cells).where("row_key = 'row-001' and family = 'cf1'").first()["value"] == "42"


def test_mutations(spark, cells):
    mutations = spark.createDataFrame([
        ("row-100", None, {"value": "100", "gone": "1"}, ["gone"], 0),
        ("row-001", "cf1", {}, ["value"], 0), ("row-001", "cf1", {"value": "43"}, None, 1),
        ("row-002", "meta", {"m": "same time"}, None, 0)], MUTATIONS)
    after = sorted(map(tuple, apply_mutations(cells, mutations, "cf1", 3).collect()))
    assert after == [("row-001", "cf1", "value", "43", 3), ("row-001", "meta", "m", "x", 2),
                     ("row-002", "meta", "m", "same time", 3), ("row-1", "cf1", "value", "z", 9),
                     ("row-100", "cf1", "value", "100", 3)]
    with pytest.raises(Exception, match="no column family"):
        apply_mutations(cells, mutations, None, 3).collect()


def test_wide_writes_and_deletes(spark, cells, folder):
    table = VersionedTable.create(spark, f"{folder}/cells", cells)
    sets = spark.createDataFrame([("row-9", "cf1", {"a": "1"}, None, 0)], MUTATIONS)
    assert write_cells(table, sets, None, 7) == 1 and table.read().count() == 6
    assert delete_rows(table, keys=["row-9", "absent"]) == {"requested": 2, "deleted": 1}
    assert delete_rows(table, prefix="row-00") == {"requested": 2, "deleted": 2}
    assert [r[0] for r in table.read().collect()] == ["row-1"]
    with pytest.raises(ValueError):
        remaining_cells(cells)


def test_wide_poll_needs_family_for_its_time_bound(cells):
    assert watch_cells(cells, "meta", 1_000_003, 1).count() == 1
    assert watch_cells(cells, None, 1_000_003, 1).count() == 5
    assert watch_cells(cells, max_rows=1).count() == 3


@pytest.fixture
def people(spark):
    return spark.createDataFrame([
        ("1", '{"firstname":"John","lastname":"Doe","age":9}'), ("2", '{"firstname":"Jane","lastname":"Doe","age":10}'),
        ("3", '{"firstname":"Charles","lastname":"Baudelaire"}'), ("4", '{"firstname":"Anon"}')], "doc_id string, data string")


def test_document_queries(people):
    found = lambda *filters, **how: [r[0] for r in docs.doc_query(people, list(filters), **how).collect()]
    doe = ("lastname", "EQUAL_TO", "Doe")
    assert sorted(found(doe)) == ["1", "2"] and found(doe, ("firstname", "EQUAL_TO", "Jane")) == ["2"]
    assert found(("lastname", "NOT_EQUAL_TO", "Doe")) == ["3"] and len(found()) == 4
    assert found(("lastname", "EQUAL_TO", None)) == ["4"]
    assert found(("age", "LESS_THAN", 10), types={"age": "int"}) == ["1"]
    assert found(order_by="firstname") == ["4", "3", "2", "1"]
    assert found(order_by="lastname", direction="DESCENDING", offset=1, limit=1) == ["1"]
    with pytest.raises(ValueError):
        found(("lastname", "LIKE", "D"))


def test_document_writes(spark, people):
    new = spark.createDataFrame([("1", None, 1), ("1", '{"a":1}', 0), (None, '{"b":2}', 0)],
                                "doc_id string, data string, seq int")
    after = {r["doc_id"]: r["data"] for r in doc_ops.doc_set(people, new).collect()}
    assert after["1"] == "{}" and len(after) == 5 and '{"b":2}' in after.values()
    maps = spark.createDataFrame([("7", {"k": "v"})], "doc_id string, data map<string,string>")
    assert '{"k":"v"}' in [r["data"] for r in doc_ops.doc_set(people, maps).collect()]
    assert doc_ops.doc_delete(people, ["1", "9"]).count() == 3
    assert docs.doc_get(people, "3").count() == 1


def test_listing_modes(spark, folder):
    import os
    os.makedirs(f"{folder}/dir/sub")
    for n in range(10):
        open(f"{folder}/dir/file {n}.txt", "w").write("x")
    open(f"{folder}/dir/sub/deep.txt", "w").write("xy")
    found = scan_folder(spark, folder, "b")
    size = lambda *a, **k: list_objects(found, "dir/", *a, **{"max_files": None, **k}).count()
    assert size("DIRECTORY") == 11 and size("DIRECTORY", "DIRECTORY") == 1 and size("DIRECTORY", "FILES") == 10
    assert size("RECURSIVE") == 11 and size("RECURSIVE", "DIRECTORY") == 0
    assert size("RECURSIVE", regexp=r"gs://b/dir/file\+\d\.txt") == 10 and size("RECURSIVE", regexp="deep") == 0
    assert size("RECURSIVE", max_files=3) == 3


def test_series(spark):
    points = spark.sql("""
        select 'm' as metric_type, map('a', a) as labels, 'GAUGE' as kind, v as value, t as start_ts, t as end_ts from values
        ('x', 1D, timestamp'2024-01-01 00:00:00'), ('x', 2D, timestamp'2024-01-01 00:04:00'),
        ('y', 3D, timestamp'2024-01-01 00:05:00'), ('y', 4D, timestamp'2024-01-01 00:05:01') as q(a, v, t)""")
    now = F.to_timestamp(F.lit("2024-01-01 00:05:00"))
    got = {r["labels"]["a"]: [p["value"] for p in r["points"]] for r in query_series(points, "true", now).collect()}
    assert got == {"x": [1.0, 2.0], "y": [3.0]}
    pushed = push_points(points, F.to_timestamp(F.lit("2024-01-01 00:05:00.7"))).first()
    assert pushed["start_ts"] == pushed["end_ts"] and pushed["end_ts"].microsecond == 0


def test_text_sessions(spark):
    turns = spark.createDataFrame([(1, 0, "user", "abcdefgh"), (1, 1, "assistant", "abcd"), (1, 2, "user", "é")],
                                  "conv_id bigint, turn bigint, role string, text string")
    assert sorted(r["turn"] for r in text.trim_history(turns, 2).collect()) == [1, 2]
    row = text.usage(turns, ["conv_id"]).first()
    assert (row["prompt_tokens"], row["candidate_tokens"], row["total_tokens"], row["serialized_bytes"]) == (3, 1, 4, 14)


def test_no_cap_unless_it_is_given(spark):
    cells = spark.range(6_000).selectExpr("concat('r', lpad(id, 5, '0')) as row_key", "'f' as family", "'q' as qualifier",
                                          "cast(id as string) as value", "id as timestamp")
    assert read_cells(cells, mode="FETCH").count() == watch_cells(cells, "f").count() == 6_000
    assert read_cells(cells, mode="FETCH", limit=10).count() == watch_cells(cells, "f", max_rows=10).count() == 10
    objects = cells.selectExpr("'b' as bucket", "row_key as name", "1L as size", "1L as generation")
    assert list_objects(objects).count() == 6_000 and list_objects(objects, max_files=3).count() == 3


def test_cell_writes_do_not_depend_on_other_entries(spark, folder):
    cells = spark.range(3_000).selectExpr("concat('r', lpad(id, 5, '0')) as row_key", "'f' as family", "'q' as qualifier",
                                          "'old' as value", "5L as timestamp")
    entry = "row_key string, family string, cells map<string,string>, delete_cells array<string>, seq int"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for name, extra in (("a", []), ("b", [("r02000", "f", {}, ["q"], 1)])):
        target = VersionedTable.create(spark, f"{folder}/{name}", cells.repartitionByRange(6, "row_key"), sort_by=["row_key"])
        before = set(target.read().inputFiles())
        entries = spark.createDataFrame([("r00007", "f", {"q": "new"}, [], 0)] + extra, entry)
        assert write_cells(target, entries, None, 5) == len(entries.collect())
        got = target.read()
        assert [r["value"] for r in got.where("row_key = 'r00007'").collect()] == ["new"]
        assert got.count() == 3_000 - len(extra)
        gone = before - set(got.inputFiles())
        assert len(gone) <= 1 + len(extra) and len(before) > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_partition_column_with_a_leading_underscore_reads_back(spark, folder):
    rows = spark.range(4).selectExpr("id", "cast(id % 2 as string) as _p")
    assert VersionedTable.create(spark, f"{folder}/t", rows, partition_by="_p").read().count() == 4


def test_new_documents_of_one_id_need_an_order(spark):
    docs = spark.createDataFrame([("1", "{}")], "doc_id string, data string")
    with pytest.raises(ValueError, match="one id"):
        doc_set(docs, spark.createDataFrame([("2", "{}"), ("2", "[]")], "doc_id string, data string"))
