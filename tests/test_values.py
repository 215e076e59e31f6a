import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from lakeops.functions import partition_ids
from lakeops.functions.checksum import combine, crc32c, crc32c_many, md5, to_base64, _byte_table
from lakeops.functions.labels import clean_label, readable_size
from lakeops.functions.schema import missing_required, to_struct_type
from lakeops.functions.values import encode_rows, normalise, range_bounds

KINDS = {"word": "STRING", "hole": "INT64", "flag": "BOOL", "ratio": "FLOAT64", "exact": "BIGNUMERIC", "day": "DATE",
         "civil": "DATETIME", "clock": "TIME", "instant": "TIMESTAMP", "place": "GEOGRAPHY", "span": "RANGE", "extra": "JSON"}
NESTED = [{"name": "counts", "type": "INT64", "mode": "REPEATED"},
          {"name": "parts", "type": "RECORD", "fields": [
              {"name": "label", "type": "STRING"}, {"name": "size", "type": "INT64"}, {"name": "marks", "type": "INT64", "mode": "REPEATED"}]}]
MATRIX = {"fields": [{"name": n, "type": k} for n, k in KINDS.items()] + NESTED}
MOMENT = dt.datetime(1999, 7, 4, 3, 21, 59, 654321)
ROW = ("żółw", None, False, -0.375, decimal.Decimal("-7.5"), MOMENT.date(), MOMENT, MOMENT.time().isoformat(), MOMENT,
       "POINT(12.5 -7e-1)", "[2031-05-06, 2031-06-07)", '{"z":[true],"a":"b"}', [9, 8], ("part", None, [7]))


@pytest.fixture(scope="module")
def matrix(spark):
    return spark.createDataFrame([ROW], to_struct_type(MATRIX))


def test_schema_needs_fields():
    with pytest.raises(ValueError):
        to_struct_type({})
    with pytest.raises(ValueError):
        to_struct_type({"fields": [{"name": "a", "type": "POLYGON"}]})


def test_required_is_checked_at_any_depth(spark):
    schema = to_struct_type({"fields": [{"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": [
        {"name": "k", "type": "INT64", "mode": "REQUIRED"}]}]})
    rows = spark.sql("select array(named_struct('k', 1L), named_struct('k', cast(null as bigint))) as r "
                     "union all select array(named_struct('k', 1L)) union all select null")
    assert sorted(r[0] for r in rows.select(missing_required(schema)).collect()) == [False, False, True]


def test_normalised_matrix(matrix):
    row = normalise(matrix, json_as="string").first()
    assert row["civil"] == MOMENT.isoformat() + "Z"
    assert row["place"] == [12.5, -0.7]
    assert row["exact"] == decimal.Decimal("-7.5")
    assert row["parts"].asDict() == {"label": "part", "size": None, "marks": [7]} and row["counts"] == [9, 8]
    assert row["span"].asDict() == {"start": dt.datetime(2031, 5, 6), "end": dt.datetime(2031, 6, 7)}
    assert row["extra"] == '{"a":"b","z":[true]}'
    assert row["hole"] is None and row["day"] == MOMENT.date() and row["word"] == "żółw"


def test_bad_point_raises(spark):
    bad = spark.createDataFrame([("LINESTRING(1 2)",)], to_struct_type(
        {"fields": [{"name": "g", "type": "GEOGRAPHY"}]}))
    with pytest.raises(Exception, match="not a POINT"):
        normalise(bad).collect()


@pytest.mark.parametrize("interval, text", [
    ("INTERVAL '1' YEAR", "1-0 0 0:0:0"), ("INTERVAL '-1-2' YEAR TO MONTH", "-1-2 0 0:0:0"),
    ("INTERVAL '-2' MONTH", "-0-2 0 0:0:0"), ("INTERVAL '3 04:05:06.5' DAY TO SECOND", "0-0 3 4:5:6.5"),
    ("INTERVAL '-4' HOUR", "0-0 0 -4:0:0")])
def test_interval_text(spark, interval, text):
    assert normalise(spark.sql(f"select {interval} as i")).first()[0] == text


def test_encoded_matrix(matrix):
    row = encode_rows(matrix).first()
    time = (MOMENT.hour << 12) | (MOMENT.minute << 6) | MOMENT.second
    date = (MOMENT.year << 26) | (MOMENT.month << 22) | (MOMENT.day << 17)
    assert row["civil"] == ((date | time) << 20) | MOMENT.microsecond
    assert row["clock"] == (time << 20) | MOMENT.microsecond
    micros = (MOMENT - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert row["day"] == micros // 86_400_000_000 and row["instant"] == micros
    assert encode_rows(matrix, compat_millis=True).first()["instant"] == micros // 1000 * 1000


def test_crc32c_against_byte_by_byte():
    def slow(data):
        register = 0xFFFFFFFF
        for byte in data:
            register = int(_byte_table()[(register ^ byte) & 255]) ^ (register >> 8)
        return register ^ 0xFFFFFFFF
    values = [bytes((i * 7 + n) % 256 for i in range(n)) for n in (0, 1, 255, 256, 257, 511, 4000, 0, 3)]
    assert crc32c_many(values) == [slow(v) for v in values]
    assert to_base64(crc32c_many([b""])[0]) == "AAAAAA=="
    assert crc32c_many([b"123456789"]) == [0xE3069283]
    assert combine(slow(values[3]), slow(values[6]), 4000) == slow(values[3] + values[6])


def test_checksum_columns(spark):
    rows = spark.createDataFrame([("",), ("123456789",), (None,)], "t string")
    got = rows.select(crc32c(F.col("t")), md5(F.col("t"))).collect()
    assert got[0][0] == "AAAAAA==" and got[0][1] == "1B2M2Y8AsgTpgAmY7PhCfg=="
    assert got[1][0] == "4waSgw==" and got[2][0] is None


def test_labels_and_sizes(spark):
    row = spark.sql("select 'My.Flow' as l, repeat('A', 70) as t, 1536 as s, 1023 as b").select(
        clean_label(F.col("l")), F.length(clean_label(F.col("t"))), readable_size(F.col("s")),
        readable_size(F.col("b"))).first()
    assert tuple(row) == ("my_flow", 63, "1.50 KB", "1023 B")


@pytest.mark.parametrize("kind, ids, low, high, kept", [
    # over a leap day, a turn of the year and a turn of the century
    ("HOUR", ["2016022822", "2016022823", "2016022900", "2016022901"], "2016-02-28T23:00:00", "2016-02-29T00:00:00", 2),
    ("DAY", ["20160227", "20160228", "20160229", "20160301", "20160302"], "2016-02-28T00:00:00", "2016-03-01T00:00:00", 3),
    ("MONTH", ["201511", "201512", "201601", "201602"], "2015-12-01T00:00:00", "2016-01-31T00:00:00", 2),
    ("YEAR", ["1998", "1999", "2000", "2001"], "1999-01-01T00:00:00", "2000-01-01T00:00:00", 2),
    ("YEAR", ["1999"], "1999-01-01T00:00", "2000-06-30T00:00:00.000000+02:00", 1),
    ("RANGE", [str(i) for i in range(0, 60, 10)], "10", "40", 4)])
def test_partition_ranges(spark, kind, ids, low, high, kept):
    rows = spark.createDataFrame([(i,) for i in [*ids, "__NULL__", "__UNPARTITIONED__"]], "p string")
    assert rows.where(partition_ids.within(F.col("p"), kind, low, high)).count() == kept


def test_range_ids(spark):
    rows = spark.sql("select explode(array(-1L, 0L, 9L, 10L, 99L, 100L, null)) as x")
    got = [r[0] for r in rows.select(partition_ids.range_id(F.col("x"), 0, 100, 10)).collect()]
    out = "__UNPARTITIONED__"
    assert got == [out, "0", "0", "10", "90", out, "__NULL__"]


def test_json_cells_keep_null_and_plain_text(spark):
    cells = spark.sql("select * from values (1, cast(null as string)), (2, 'not json'), (3, '[1, 2]'), (4, 'null') as t(id, text)").select(
        "id", F.col("text").alias("text", metadata={"declared": "JSON"}))
    got = {r["id"]: r["text"] for r in normalise(cells, json_as="string").collect()}
    assert got == {1: None, 2: '"not json"', 3: "[1,2]", 4: "null"}


def test_range_bounds_are_times_and_bad_text_is_an_error(spark):
    def bounds(text):
        return spark.createDataFrame([(text,)], "r string").select(range_bounds(F.col("r")).alias("r")).first()["r"]
    assert tuple(bounds("[2022-12-01 10:30:00.5, UNBOUNDED)")) == (dt.datetime(2022, 12, 1, 10, 30, 0, 500_000), None)
    assert tuple(bounds("[2022-12-01T10:30:00+01:00, 2022-12-02T00:00:00Z)")) == (dt.datetime(2022, 12, 1, 9, 30), dt.datetime(2022, 12, 2))
    assert bounds(None) is None
    for text in ("garbage", "[soon, later)"):
        with pytest.raises(Exception, match="not a RANGE"):
            bounds(text)
