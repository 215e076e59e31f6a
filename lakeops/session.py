"""Scratch space and small file-system helpers shared by all operators."""

from __future__ import annotations

import functools
import json
import os
import shutil
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="/tmp/run-")


@functools.lru_cache(maxsize=8)
def _ship(application_id: str) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='/tmp/run-')}/lakeops", "zip",
                                  os.path.dirname(package), os.path.basename(package))
    SparkSession.active().sparkContext.addPyFile(archive)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the few Python tasks."""
    _ship(spark.sparkContext.applicationId)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing directory that every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_database(spark: SparkSession, label: str) -> str:
    """A new catalog database whose managed tables live in scratch space."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, label)}'")
    return name


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, for use inside tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


# Driver-side metadata access: listings of table folders and one small JSON file per
# table version. Data never passes through here.

def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the file sources report it."""
    jpath, fs = _hadoop(spark, path)
    return fs.makeQualified(jpath).toString()


def list_names(spark: SparkSession, path: str, dirs_only: bool = False) -> list[str]:
    """Names directly below ``path`` without hidden ones; empty if it does not exist.

    A folder of a partition value, ``_column=value``, is not hidden.
    """
    jpath, fs = _hadoop(spark, path)
    if not fs.exists(jpath):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(jpath)]
    return sorted(n for n, d in found if (n[0] not in "._" or d and "=" in n) and (d or not dirs_only))


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    jpath, fs = _hadoop(spark, path)
    return bool(fs.delete(jpath, True))


def read_json(spark: SparkSession, path: str) -> dict:
    jpath, fs = _hadoop(spark, path)
    stream = fs.open(jpath)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


class VersionConflict(RuntimeError):
    """Another writer committed the same version first."""


def put_json_if_absent(spark: SparkSession, path: str, value: dict) -> None:
    """Publish a small file in one step; fails if the name is already taken."""
    jvm = spark._jvm
    target, fs = _hadoop(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged, False)
    try:
        out.write(bytearray(json.dumps(value).encode("utf-8")))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(staged, False)
        raise VersionConflict(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(staged, target, options)
    except Exception as error:
        if fs.exists(target):
            raise VersionConflict(path) from error
        raise
