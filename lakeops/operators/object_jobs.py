"""Bulk object jobs: compose, copy, move, delete, checksum, verify, stage.

The listing is a DataFrame; executors read and write the objects themselves, in buffers. Every
step may run twice: files appear under their name only when complete, and a move deletes
sources in a second job, after the manifest of all copies has been written.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.checksum import crc32c_of, fold_ranges
from lakeops.session import locate, materialise, ship_package

# The most parts one composed object may have, the copy buffer, and what may
# happen to a source after it was read.
COMPOSE_PARTS = 32
BUFFER = 8 * 1024 * 1024
ACTIONS = ("NONE", "MOVE", "DELETE")


class NoObjectsError(FileNotFoundError):
    """The listing is empty."""


# ---------------------------------------------------------------- helpers inside tasks

def _write_whole(target: str, sources: list[str]) -> int:
    """Streams the sources, one after the other, into ``target``."""
    fs, path = locate(target)
    renames = fs.type_name in ("local", "hdfs")
    place = f"{path}.{uuid.uuid4().hex}.part" if renames else path
    if renames:
        fs.create_dir(posixpath.dirname(path), recursive=True)
    written = 0
    with fs.open_output_stream(place) as out:
        for source in sources:
            from_fs, from_path = locate(source)
            with from_fs.open_input_stream(from_path) as data:
                while chunk := data.read(BUFFER):
                    out.write(chunk)
                    written += len(chunk)
    if renames:
        fs.move(place, path)
    return written


def _range_crc(location: str, start: int, length: int) -> int:
    """CRC32C of a range of a stored object, read and folded in buffers, so that its length costs no memory."""
    fs, path = locate(location)
    with fs.open_input_file(path) as data:
        return crc32c_of(data.read_at(min(BUFFER, start + length - at), at) for at in range(start, start + length, BUFFER))


def _remove(uri: str) -> None:
    fs, path = locate(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """One object is one unit of work, so rows go to tasks by the hash of a unique name."""
    ship_package(df.sparkSession)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism * 4, 1)
    return df.repartition(tasks, *columns)


# ---------------------------------------------------------------- jobs

def compose(parts: DataFrame, allow_empty: bool = False, max_parts: int | None = COMPOSE_PARTS) -> DataFrame:
    """Joins objects byte by byte, in ``position`` order, into each ``target``.

    ``parts`` holds ``target, position, location``; more than ``max_parts`` parts of
    a target are refused before anything is written. Returns ``target, parts, size``.
    """
    counts = parts.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    if max_parts is not None and counts.where(F.col("n") > max_parts).head(1):
        raise ValueError(f"at most {max_parts} parts per composed object")
    if not allow_empty and not parts.head(1):
        raise NoObjectsError("no objects to compose")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["size"] = [_write_whole(t, list(s)) for t, s in zip(batch["target"], batch["sources"])]
            batch["parts"] = [len(s) for s in batch["sources"]]
            yield batch[["target", "parts", "size"]]

    ordered = (parts.groupBy("target")
                    .agg(F.sort_array(F.collect_list(F.struct("position", "location"))).alias("p"))
                    .select("target", F.col("p.location").alias("sources")))
    return materialise(_spread(ordered, "target").mapInPandas(
        write, "target string, parts int, size bigint"), "compose")


def with_targets(listing: DataFrame, directory: str) -> DataFrame:
    """Target = directory plus base name. Two equal base names or a copy onto itself raise."""
    base = F.element_at(F.split("name", "/"), -1)
    planned = listing.withColumn(
        "target", F.concat(F.lit(directory.rstrip("/") + "/"), base))
    if planned.groupBy("target").count().where("count > 1").head(1):
        raise ValueError("two objects share a base name")
    plain = F.regexp_replace("location", "^file:/*", "/")
    if planned.where(plain == F.regexp_replace("target", "^file:/*", "/")).head(1):
        raise ValueError("source and target are the same")
    return planned


def transfer(listing: DataFrame, action: str, directory: str | None = None) -> DataFrame:
    """COPY or MOVE the listed objects into ``directory``, DELETE them, or do NONE.

    Returns the manifest ``name, location, target, size``.
    """
    action = action.upper()
    if action == "NONE":
        return listing.select("name", "location", F.col("location").alias("target"), "size")
    if action == "DELETE":
        return remove(listing).select("name", "location", F.lit(None).cast("string").alias("target"), "size")
    if action not in ("COPY", "MOVE"):
        raise ValueError(f"unknown action {action}")
    if not directory:
        raise ValueError(f"{action} needs a directory")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["size"] = [_write_whole(t, [s]) for t, s in zip(batch["target"], batch["location"])]
            yield batch

    planned = with_targets(listing, directory).select("name", "location", "target", "size")
    manifest = materialise(_spread(planned, "target").mapInPandas(
        copy, "name string, location string, target string, size bigint"), "manifest")
    if action == "MOVE":
        remove(manifest)
    return manifest


def remove(listing: DataFrame) -> DataFrame:
    """Deletes the listed objects; returns those that existed, with their sizes.

    What exists is written down before the first delete, so a task that runs twice does not
    lose its count.
    """
    def stat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            infos = [fs.get_file_info(path) for fs, path in map(locate, batch["location"])]
            batch["size"] = [i.size or 0 for i in infos]
            yield batch[[i.type == pafs.FileType.File for i in infos]]

    def erase(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for location in batch["location"]:
                _remove(location)
            yield batch

    schema = "name string, location string, size bigint"
    named = listing.select("name", "location", F.col("size").cast("bigint").alias("size"))
    found = materialise(_spread(named, "location").mapInPandas(stat, schema), "found")
    _spread(found, "location").mapInPandas(erase, schema).write.format("noop").mode("overwrite").save()
    return found


def delete_objects(listing: DataFrame, error_on_empty: bool = False,
                   error_on_missing: bool = False) -> DataFrame:
    """Count and bytes of the objects really deleted."""
    if error_on_empty and not listing.head(1):
        raise NoObjectsError("no objects to delete")
    wanted = listing.count() if error_on_missing else None
    deleted = remove(listing).agg(F.count(F.lit(1)).alias("count"),
                                  F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    if wanted is not None and deleted.first()["count"] < wanted:
        raise FileNotFoundError("some listed objects do not exist")
    return deleted


# ---------------------------------------------------------------- checksums

def object_checksums(listing: DataFrame, range_bytes: int = 64 * 1024 * 1024,
                     with_md5: bool = False) -> DataFrame:
    """``location, size, crc32c`` (and ``md5``) of stored objects.

    Objects are read in ranges by different tasks, and the range CRCs combine, so one very
    large object does not hold up a task. MD5 cannot be combined: it streams through one
    task per object and is only computed on request.
    """
    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["crc"] = [_range_crc(x, int(start), int(length))
                            for x, start, length in zip(batch["location"], batch["start"], batch["length"])]
            yield batch

    last = F.greatest(F.col("size") - 1, F.lit(0))
    pieces = (listing.select("location", "size",
                             F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(range_bytes).cast("bigint"))).alias("start"))
                     .withColumn("length", F.least(F.lit(range_bytes), F.col("size") - F.col("start"))))
    read = _spread(pieces, "location", "start").mapInPandas(
        ranges, "location string, size bigint, start bigint, length bigint, crc bigint")
    # an object store's size limit bounds this list: 5 TiB in 64 MiB ranges is 82,000 entries
    folded = (read.groupBy("location", "size")
                  .agg(F.sort_array(F.collect_list(F.struct("start", "length", "crc"))).alias("p"))
                  .select("location", "size", fold_ranges("p").alias("crc32c")))
    if not with_md5:
        return folded

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64
        for batch in batches:
            sums = []
            for location in batch["location"]:
                fs, path = locate(location)
                value = hashlib.md5()
                with fs.open_input_stream(path) as data:
                    while chunk := data.read(BUFFER):
                        value.update(chunk)
                sums.append(base64.b64encode(value.digest()).decode("ascii"))
            batch["md5"] = sums
            yield batch

    md5s = _spread(listing.select("location"), "location").mapInPandas(
        digest, "location string, md5 string")
    return folded.join(md5s, "location")


def mismatches(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Expected entries the actual ones do not meet, with the reason.

    CRC32C decides when it is known, else MD5; an entry with neither cannot be verified.
    """
    a, e = actual.alias("a"), expected.alias("e")
    joined = e.join(a, F.col(f"a.{key}") == F.col(f"e.{key}"), "left")
    differs = (F.when(F.col("e.crc32c").isNotNull(), ~F.col("a.crc32c").eqNullSafe(F.col("e.crc32c")))
                .otherwise(~F.col("a.md5").eqNullSafe(F.col("e.md5"))))
    reason = (F.when(F.col(f"a.{key}").isNull(), "missing")
               .when(F.col("e.crc32c").isNull() & F.col("e.md5").isNull(), "no checksum")
               .when(F.col("e.size").isNotNull() & (F.col("a.size") != F.col("e.size")), "size")
               .when(differs, "checksum"))
    return joined.select(F.col(f"e.{key}").alias(key), reason.alias("reason")).where("reason is not null")


def verify(actual: DataFrame, expected: DataFrame, key: str) -> None:
    bad = mismatches(actual, expected, key).head(5)
    if bad:
        raise ValueError(f"verification failed: {[tuple(r) for r in bad]}")


def stage_in(listing: DataFrame, directory: str, action: str = "NONE",
             move_directory: str | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Fetch listed objects into ``directory``, verify them, then act on the sources.

    ``expected`` (``name, size, crc32c, md5``) wins over the check of the transfer itself,
    which compares source and copy. Returns ``name, uri, size``.
    """
    if action.upper() not in ACTIONS:
        raise ValueError(f"action is one of {ACTIONS}")
    manifest = transfer(listing, "COPY", directory)
    copies = manifest.select("name", F.col("target").alias("location"), "size")
    by_name = copies.select("name", "location")
    needs_md5 = expected is not None and bool(expected.where("crc32c is null").head(1))
    actual = object_checksums(copies, with_md5=needs_md5).join(by_name, "location")
    if not needs_md5:
        actual = actual.withColumn("md5", F.lit(None).cast("string"))
    if expected is None:
        expected = (object_checksums(manifest.select("location", "size"))
                    .join(manifest.select("location", "name"), "location")
                    .withColumn("md5", F.lit(None).cast("string")))
    verify(actual, expected, "name")
    if action.upper() != "NONE":
        transfer(listing, action, move_directory)
    return copies.select("name", F.col("location").alias("uri"), "size")
