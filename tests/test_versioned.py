import pytest
from pyspark.sql import functions as F

from lakeops.operators.versioned import Delete, Insert, Merge, Update, VersionedTable
from lakeops.session import VersionConflict


@pytest.fixture
def users(spark, folder):
    rows = spark.createDataFrame([(1, "Ann", "a"), (2, "Bob", "a"), (3, "Cy", "b/ c"), (4, "Di", None)],
                                 "id bigint, name string, team string")
    return VersionedTable.create(spark, f"{folder}/users", rows, "team")


def state(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def test_counts_and_untouched_partitions(users):
    before = users.head()["folders"]
    assert users.execute(Update({"name": "upper(name)"}, "id = 3")) == 1
    after = users.head()["folders"]
    assert sum(before[k] == after[k] for k in before) == 2
    assert users.execute(Delete("team is null")) == 1
    assert users.execute(Delete("id > 100")) == 0
    assert state(users) == [(1, "Ann", "a"), (2, "Bob", "a"), (3, "CY", "b/ c")]
    assert users.versions() == [0, 1, 2]


def test_null_predicates_do_not_match(users):
    assert users.execute(Delete("team <> 'a'")) == 1
    assert users.execute(Update({"name": "'x'"}, "team = 'a'")) == 2


def test_update_moves_rows_between_partitions(users):
    assert users.execute(Update({"team": "'a'"}, F.col("id") == 3)) == 1
    assert state(users)[2] == (3, "Cy", "a") and len(users.head()["folders"]) == 2


def test_batch_counts_see_earlier_steps(spark, users):
    new = spark.createDataFrame([(10, "Alice", "a"), (11, "Bob", "z")], "id bigint, name string, team string")
    assert users.execute_batch([Insert(new), Update({"name": "'B'"}, "name = 'Bob'"), Delete("id = 11")]) == [2, 2, 1]
    assert [r[0] for r in state(users)] == [1, 2, 3, 4, 10] and users.versions() == [0, 1]


def test_failing_batch_changes_nothing(users):
    before = state(users)
    with pytest.raises(Exception):
        users.execute_batch([Delete("id = 1"), Update({"id": "cast(name as bigint)"}, "id = 2")])
    assert state(users) == before and users.versions() == [0]


def test_merge(spark, users):
    source = spark.createDataFrame([(2, "Bill", "a"), (9, "New", "n")], "id bigint, name string, team string")
    assert users.execute(Merge(source, ["id"], {"name": "source.name"})) == 2
    assert (2, "Bill", "a") in state(users) and (9, "New", "n") in state(users)
    assert users.execute(Merge(source, ["id"], delete_matched=True)) == 2
    assert [r[0] for r in sorted(map(tuple, users.read().collect()), key=lambda r: r[0])] == [1, 3, 4]
    with pytest.raises(ValueError, match="once"):
        users.execute(Merge(source.union(source), ["id"], {"name": "source.name"}))


def test_snapshot_clone_restore(spark, users, folder):
    users.snapshot("s")
    users.execute(Delete("id <= 2"))
    copy = users.clone(f"{folder}/copy", version=0)
    copy.execute(Update({"name": "'copy'"}, "id = 1"))
    copy.append(spark.createDataFrame([(5, "Eve", "a")], "id bigint, name string, team string"))
    assert [r[0] for r in copy.read().collect()].count(5) == 1 and copy.read().count() == 5
    assert users.read().count() == 2 and users.read_snapshot("s").count() == 4
    users.restore(0)
    assert users.read().count() == 4 and users.read(1).count() == 2
    with pytest.raises(ValueError):
        users.clone(f"{folder}/copy")


def test_second_writer_loses(spark, users):
    stale = users.head()
    users.execute(Delete("id = 1"))
    added = users.stage(spark.createDataFrame([(7, "x", "a")], "id bigint, name string, team string"), stale)
    with pytest.raises(VersionConflict):
        users._publish(stale, added)
    assert users.read().count() == 3


def test_transactions_are_taken_once(spark, users):
    row = spark.createDataFrame([(7, "x", "a")], "id bigint, name string, team string")
    for _ in range(2):
        users.append(row, ("writer", 0))
    assert users.read().count() == 5


def test_table_without_partitions_can_become_empty(spark, folder):
    table = VersionedTable.create(spark, f"{folder}/t", spark.range(5))
    assert table.execute(Delete("true")) == 5 and table.read().count() == 0
    assert table.execute(Insert(spark.range(2))) == 2 and table.read().count() == 2


def test_only_files_with_hits_are_rewritten(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = VersionedTable.create(spark, f"{folder}/t", spark.range(8000), sort_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = lambda: {r[0] for r in table.read().select(F.input_file_name()).collect()}
    before = files()
    assert table.execute(Delete("id = 17")) == 1
    assert len(before) > 4 and len(before - files()) == 1
    assert table.execute_batch([Update({"id": "-id"}, "id = 18"), Delete("id = 7999")]) == [1, 1]
    assert sorted(r[0] for r in table.read().collect()) == [-18, *(i for i in range(7999) if i not in (17, 18))]
