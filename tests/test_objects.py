import glob
import os
import tracemalloc

import pytest
from pyspark.sql import functions as F

from lakeops.functions.checksum import crc32c_many, to_base64
from lakeops.operators import object_jobs as jobs
from lakeops.sources.objects import scan_folder


@pytest.fixture
def source(folder):
    os.makedirs(f"{folder}/in/sub")
    for n, text in enumerate(("1\n", "2\n", "3\n"), 1):
        open(f"{folder}/in/{n}.txt", "w").write(text)
    open(f"{folder}/in/sub/big file.bin", "wb").write(bytes(range(256)) * 40)
    open(f"{folder}/in/empty", "w").close()
    return f"{folder}/in"


def test_compose(spark, source, folder):
    parts = scan_folder(spark, source).where(F.col("name").rlike("^[123].txt$")).select(
        F.lit(f"{folder}/out/all.txt").alias("target"), F.col("name").alias("position"), "location")
    got = jobs.compose(parts).first()
    assert open(f"{folder}/out/all.txt").read() == "1\n2\n3\n" and (got["parts"], got["size"]) == (3, 6)
    with pytest.raises(jobs.NoObjectsError):
        jobs.compose(parts.limit(0))
    assert jobs.compose(parts.limit(0), allow_empty=True).count() == 0
    many = parts.crossJoin(spark.range(11))
    with pytest.raises(ValueError, match="32"):
        jobs.compose(many)


def test_copy_and_move(spark, source, folder):
    listing = scan_folder(spark, source)
    assert jobs.transfer(listing, "COPY", f"{folder}/copy").count() == 5
    assert open(f"{folder}/copy/big file.bin", "rb").read() == bytes(range(256)) * 40
    assert jobs.transfer(listing, "MOVE", f"{folder}/move").agg(F.sum("size")).first()[0] == 6 + 10240
    assert not [p for p in glob.glob(f"{source}/**", recursive=True) if os.path.isfile(p)]
    assert len(os.listdir(f"{folder}/move")) == 5


def test_copy_guards(spark, source, folder):
    open(f"{source}/sub/1.txt", "w").write("other")
    with pytest.raises(ValueError, match="base name"):
        jobs.transfer(scan_folder(spark, source), "COPY", f"{folder}/copy")
    with pytest.raises(ValueError, match="same"):
        jobs.transfer(scan_folder(spark, source).where("name = '2.txt'"), "COPY", source)
    assert not os.path.exists(f"{folder}/copy")


def test_delete_counts_real_deletes(spark, source):
    listing = spark.createDataFrame(
        [tuple(r) for r in scan_folder(spark, source).select("name", "location", "size").collect()],
        "name string, location string, size bigint")
    os.remove(f"{source}/1.txt")
    assert tuple(jobs.delete_objects(listing).first()) == (4, 4 + 10240)
    assert tuple(jobs.delete_objects(listing).first()) == (0, 0)
    with pytest.raises(FileNotFoundError):
        jobs.delete_objects(listing, error_on_missing=True)
    with pytest.raises(jobs.NoObjectsError):
        jobs.delete_objects(listing.limit(0), error_on_empty=True)


def test_range_checksums_match_whole_files(spark, source):
    sums = {r["location"]: r for r in jobs.object_checksums(scan_folder(spark, source), 100, with_md5=True).collect()}
    assert len(sums) == 5
    for location, row in sums.items():
        data = open(location[5:], "rb").read()
        assert row["crc32c"] == to_base64(crc32c_many([data])[0])
    assert [r["crc32c"] for k, r in sums.items() if k.endswith("empty")] == ["AAAAAA=="]


def test_verification_order(spark):
    schema = "name string, size bigint, crc32c string, md5 string"
    actual = spark.createDataFrame([(n, 1, "c", "m") for n in "abcde"], schema)
    expected = spark.createDataFrame([
        ("a", 1, "c", "wrong"), ("b", 1, None, "m"), ("c", 2, "c", "m"), ("d", None, None, None),
        ("e", None, "wrong", "m"), ("f", 1, "c", "m")], schema)
    got = {r["name"]: r["reason"] for r in jobs.mismatches(actual, expected, "name").collect()}
    assert got == {"c": "size", "d": "no checksum", "e": "checksum", "f": "missing"}
    with pytest.raises(ValueError):
        jobs.verify(actual, expected, "name")


def test_stage_in(spark, source, folder):
    listing = scan_folder(spark, source)
    wrong = spark.createDataFrame([("1.txt", 2, None, "bm8=")], "name string, size bigint, crc32c string, md5 string")
    with pytest.raises(ValueError, match="verification"):
        jobs.stage_in(listing, f"{folder}/bad", expected=wrong)
    assert os.path.exists(f"{source}/1.txt")
    staged = jobs.stage_in(listing, f"{folder}/good", "MOVE", f"{folder}/done")
    assert staged.count() == 5 and len(os.listdir(f"{folder}/done")) == 5 and not os.path.exists(f"{source}/1.txt")


def test_a_range_is_summed_in_little_memory(spark, tmp_path):
    path = tmp_path / "large"
    data = bytes(range(251)) * (160 * 1024)  # 39 MB
    path.write_bytes(data)
    expected, size = crc32c_many([data])[0], len(data)
    del data
    tracemalloc.start()
    try:
        assert jobs._range_crc(str(path), 0, size) == expected
        assert tracemalloc.get_traced_memory()[1] < size
    finally:
        tracemalloc.stop()
    listing = scan_folder(spark, str(tmp_path))
    assert [r["crc32c"] for r in jobs.object_checksums(listing).collect()] == [to_base64(expected)]
