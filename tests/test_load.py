import pytest
from pyspark.sql import functions as F

from lakeops.operators.versioned import Delete, VersionedTable
from lakeops.sources.load import (BadRecordsError, CsvOptions, EmptyInputError, check_uris, load, load_into,
                                  raw_avro_types)

PEOPLE = {"fields": [{"name": "id", "type": "INT64", "mode": "REQUIRED"}, {"name": "name", "type": "STRING"},
                     {"name": "age", "type": "INT64"}]}


def put(folder, name, text, encoding="utf-8"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding=encoding, newline="") as out:
        out.write(text)
    return path


def ids(result):
    return sorted(r["id"] for r in result.rows.collect())


DIRTY = '1|a|1\n2|b\n3|c|3|x\nzz|d|4\n5|"e\nf"|5\n|g|6\n7|"open|7\n'


@pytest.mark.parametrize("jagged, ignore, kept", [
    (False, False, [1, 5]), (True, False, [1, 2, 5]), (False, True, [1, 3, 5]), (True, True, [1, 2, 3, 5])])
def test_csv_policies(spark, folder, jagged, ignore, kept):
    path = put(folder, "a.csv", DIRTY)
    options = CsvOptions(delimiter="|", allow_jagged_rows=jagged, allow_quoted_newlines=True)
    got = load(spark, path, "csv", PEOPLE, csv=options, ignore_unknown_values=ignore, max_bad_records=9)
    assert ids(got) == kept
    stats = got.stats.first()
    assert stats["bad_records"] == 7 - len(kept) and stats["output_rows"] == len(kept)
    assert stats["input_files"] == 1 and stats["input_bytes"] == len(DIRTY)


def test_budget(spark, folder):
    path = put(folder, "a.csv", DIRTY)
    options = CsvOptions(delimiter="|", allow_quoted_newlines=True)
    with pytest.raises(BadRecordsError) as error:
        load(spark, path, "csv", PEOPLE, csv=options, max_bad_records=4)
    assert error.value.found == 5
    assert load(spark, path, "csv", PEOPLE, csv=options, max_bad_records=5).bad.count() == 5


def test_skips_leading_rows_of_every_file(spark, folder):
    for name in "abc":
        put(folder, f"{name}.csv", "".join(f"{i},x,{i}\n" for i in range(6)))
    for skip, rows in ((0, 18), (1, 15), (2, 12), (5, 3), (7, 0)):
        got = load(spark, folder, "csv", PEOPLE, csv=CsvOptions(skip_leading_rows=skip))
        assert got.rows.count() == rows
        assert got.rows.where(F.col("id") < skip).count() == 0


def test_skips_leading_rows_of_files_read_in_many_splits(spark, folder):
    for name in "ab":
        put(folder, f"{name}.csv", "".join(f"{i},{'x' * 20},{i}\n" for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = load(spark, folder, "csv", PEOPLE, csv=CsvOptions(skip_leading_rows=3))
        assert sorted(r["id"] for r in got.rows.collect()) == sorted([*range(3, 400)] * 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latin_text(spark, folder):
    path = put(folder, "l.csv", "1,José,3\n", "iso-8859-1")
    assert load(spark, path, "csv", PEOPLE, csv=CsvOptions(encoding="ISO-8859-1")).rows.first()["name"] == "José"


def test_autodetect_jagged(spark, folder):
    path = put(folder, "i.csv", 'policy|county|limit|unit\n1|"CLAY"|1.5\n2|"CLAY"|2|3\n')
    got = load(spark, path, "csv", autodetect=True,
               csv=CsvOptions(delimiter="|", skip_leading_rows=1, allow_jagged_rows=True))
    assert dict(got.rows.dtypes) == {"policy": "int", "county": "string", "limit": "double", "unit": "int"}
    assert got.rows.count() == 2


def test_empty_input(spark, folder):
    path = put(folder, "e.csv", "")
    with pytest.raises(EmptyInputError):
        load(spark, path, "csv", PEOPLE)
    got = load(spark, path, "csv", PEOPLE, fail_on_empty=False)
    assert got.rows.count() == 0 and got.stats.first()["output_rows"] == 0


def test_json_unknown_keys_at_depth(spark, folder):
    schema = {"fields": [{"name": "id", "type": "INT64", "mode": "REQUIRED"},
                         {"name": "in", "type": "RECORD", "fields": [{"name": "a", "type": "INT64"}]},
                         {"name": "list", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "b", "type": "INT64"}]}]}
    path = put(folder, "a.json", "\n".join([
        '{"id":1,"in":{"a":1},"list":[{"b":1}]}', '{"id":2,"zz":1}', '{"id":3,"in":{"a":1,"q":2}}',
        '{"id":4,"list":[{"b":1},{"b":2,"q":3}]}', 'no json', '{"id":"x"}', '{"in":{"a":1}}', '', '{"id":8}']))
    assert ids(load(spark, path, "json", schema, max_bad_records=9)) == [1, 8]
    lenient = load(spark, path, "json", schema, max_bad_records=3, ignore_unknown_values=True)
    assert ids(lenient) == [1, 2, 3, 4, 8]


def test_typed_formats_check_required(spark, folder):
    rows = spark.createDataFrame([(1, "a", 2), (None, "b", 3)], "id bigint, name string, age bigint")
    rows.write.parquet(folder + "/p")
    with pytest.raises(BadRecordsError):
        load(spark, folder + "/p", "parquet", PEOPLE)
    assert ids(load(spark, folder + "/p", "parquet", PEOPLE, max_bad_records=1)) == [1]


def test_star_rule():
    assert check_uris("s3://bucket/dir/*.csv") == ["s3://bucket/dir/*.csv"]
    for bad in (["s3://bucket/*/*.csv"], ["s3://buck*/a.csv"], []):
        with pytest.raises(ValueError):
            check_uris(bad)


def test_avro_needs_its_package_and_raw_types(spark, folder):
    path = put(folder, "x.avro", "not empty")
    with pytest.raises(RuntimeError, match="spark-avro"):
        load(spark, path, "avro")
    raw = raw_avro_types(spark.sql("select date'1970-01-03' as d, timestamp'1970-01-01 00:00:01' as t, 'x' as s"))
    assert tuple(raw.first()) == (2, 1_000_000, "x")


@pytest.mark.parametrize("partition", [None, "kind"])
def test_load_into_versions_publishes_good_rows_only(spark, folder, partition):
    path = put(folder, "a.csv", DIRTY)
    empty = spark.createDataFrame([], "id bigint, name string, age bigint, kind string")
    table = VersionedTable.create(spark, f"{folder}/t", empty, partition)
    how = {"csv": CsvOptions(delimiter="|", allow_quoted_newlines=True),
           "derive": {"kind": F.when(F.col("id") > 2, "high").otherwise("low")}}
    with pytest.raises(BadRecordsError):
        load_into(table, path, "csv", PEOPLE, max_bad_records=4, **how)
    assert table.read().count() == 0
    assert load_into(table, path, "csv", PEOPLE, max_bad_records=5, **how) == {"output_rows": 2, "bad_records": 5}
    table.append(spark.createDataFrame([(9, "z", 9, "high")], "id bigint, name string, age bigint, kind string"))
    assert table.execute(Delete("id = 1")) == 1
    assert sorted((r["id"], r["kind"]) for r in table.read().collect()) == [(5, "high"), (9, "high")]
