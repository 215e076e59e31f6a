"""Object listings: metadata rows from a folder, and prefix / folding / regex views of them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import locate, materialise, qualified, ship_package

# Listing modes and filters.
LISTING_TYPES = ("DIRECTORY", "RECURSIVE")
FILTERS = ("FILES", "DIRECTORY", "BOTH")


def object_uri(bucket: Column, name: Column) -> Column:
    """The URI of an object; blanks become plus signs."""
    return F.replace(F.concat(F.lit("gs://"), bucket, F.lit("/"), name), F.lit(" "), F.lit("+"))


_ENTRY = "name string, is_folder boolean, size bigint, modified bigint"


def scan_folder(spark: SparkSession, path: str, bucket: str = "") -> DataFrame:
    """Metadata of every file below ``path``, empty ones too; contents are not read.

    Folders are listed by the executors, one level of the tree per job, and each level is
    written down, so the listing stays one and the same while files come and go.
    """
    ship_package(spark)
    root = qualified(spark, path).rstrip("/") + "/"
    tasks = spark.sparkContext.defaultParallelism * 4

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["name"]:
                fs, place = locate(root + folder)
                found = fs.get_file_info(pafs.FileSelector(place.rstrip("/") or "/", allow_not_found=True))
                yield pd.DataFrame({
                    "name": [f"{folder}{i.base_name}" for i in found],
                    "is_folder": [i.type == pafs.FileType.Directory for i in found],
                    "size": [i.size or 0 for i in found],
                    "modified": [(i.mtime_ns or 0) // 1000 for i in found]})

    level = spark.createDataFrame([("",)], "name string")
    files = None
    while True:
        listed = materialise(level.mapInPandas(children, _ENTRY), "listing")
        here = listed.where(~F.col("is_folder"))
        files = here if files is None else files.unionByName(here)
        folders = listed.where("is_folder")
        if not folders.head(1):
            break
        level = folders.select(F.concat("name", F.lit("/")).alias("name")).repartition(tasks, "name")
    return files.select(
        F.lit(bucket).alias("bucket"), "name", "size", F.col("modified").alias("generation"),
        F.lit(1).cast("bigint").alias("metageneration"), F.concat(F.lit(root), "name").alias("location"))


def list_objects(objects: DataFrame, prefix: str = "", listing_type: str = "DIRECTORY",
                 keep: str = "BOTH", regexp: str | None = None,
                 max_files: int | None = None, all_versions: bool = False) -> DataFrame:
    """Names below ``prefix`` in one bucket.

    DIRECTORY keeps immediate children and folds deeper names into one entry per
    sub-directory; RECURSIVE keeps every name. The regex must match the whole URI.
    Without ``all_versions`` only the newest generation of a name is listed.
    """
    listing_type, keep = listing_type.upper(), keep.upper()
    if listing_type not in LISTING_TYPES or keep not in FILTERS:
        raise ValueError(f"listing type in {LISTING_TYPES}, filter in {FILTERS}")
    found = objects.where(F.col("name").startswith(prefix)) if prefix else objects
    found = found.select("bucket", "name", "size", "generation")
    if not all_versions:
        found = (found.groupBy("bucket", "name")
                      .agg(F.max_by("size", "generation").alias("size"),
                           F.max("generation").alias("generation")))
    if listing_type == "DIRECTORY":
        rest = F.substring(F.col("name"), len(prefix) + 1, 1 << 30)
        below = F.locate("/", rest)
        folder = F.when(below > 0, F.concat(F.lit(prefix), F.substring(rest, F.lit(1), below)))
        tagged = found.withColumn("_folder", folder)
        files = tagged.where(F.col("_folder").isNull()).drop("_folder")
        folders = (tagged.where(F.col("_folder").isNotNull())
                         .groupBy("bucket", F.col("_folder").alias("name")).agg(
                             F.lit(0).cast("bigint").alias("size"),
                             F.lit(None).cast("bigint").alias("generation")))
        found = files.unionByName(folders)
    entries = found.withColumn("uri", object_uri(F.col("bucket"), F.col("name")))
    entries = entries.withColumn("is_directory", F.col("name").endswith("/"))
    if keep != "BOTH":
        entries = entries.where(F.col("is_directory") == F.lit(keep == "DIRECTORY"))
    if regexp is not None:
        entries = entries.where(F.col("uri").rlike(f"^(?:{regexp})$"))
    if max_files is not None:
        entries = entries.orderBy("name", "generation").limit(max_files)
    return entries
