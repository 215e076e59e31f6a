"""Helpers that several operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import delete_path, materialise, ship_package

#: Text handled at once inside a Python task; longer documents are handled alone.
SLICE_BYTES = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))


def map_batches(df: DataFrame, schema: str | T.StructType,
                function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` with this package present on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text, one row at least in each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(lengths):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null as empty."""
    return [b"" if v is None else v for v in column(batch, name).cast(pa.binary()).to_pylist()]


def pieces(text: bytes, limit: int = 4 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``limit`` bytes."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + limit)
        stop = cut.start() if cut else len(text)
        yield text[at:stop].split()
        at = stop


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; Spark then removes the shuffles that it took.

    The disk that a chain of steps needs stays near that of its largest step.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return materialise(df, label)
    finally:
        conf.set(_CLEANUP, before)


def discard(*written: DataFrame) -> None:
    """Remove settled steps that nothing reads any more: all that came of them is written down too."""
    for step in written:
        for path in {file.rsplit("/", 1)[0] for file in step.inputFiles()}:
            delete_path(step.sparkSession, path)


def task_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def with_rank(df: DataFrame, key: str, name: str, label: str) -> DataFrame:
    """A gapless number from 0 for the rows of each value of the integer column ``key``.

    Each task counts its own rows of a key; the rows are written down with those counts, so that
    a repeated task cannot number them differently. Offsets come from one line per task and key.
    No row moves for the numbering, and a key with a third of all rows stays spread out.
    """
    names = [f.name for f in df.schema.fields]
    out = T.StructType([*df.schema.fields, T.StructField("_task", T.LongType()), T.StructField("_local", T.LongType())])

    def count(batches):
        seen: dict[int, int] = {}
        task = task_number()
        for batch in batches:
            local = []
            for value in column(batch, key).to_pylist():
                n = seen.get(value, 0)
                local.append(n)
                seen[value] = n + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * batch.num_rows, pa.int64()), pa.array(local, pa.int64())],
                names=[*names, "_task", "_local"])

    placed = settle(map_batches(df, out, count), label)
    before = Window.partitionBy("_key").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(F.col(key).alias("_key"), F.col("_task").alias("_from"))
                     .agg(F.count(F.lit(1)).alias("_n"))
                     .select("_key", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (placed.join(offsets, (F.col(key) == F.col("_key")) & (F.col("_task") == F.col("_from")))
                  .withColumn(name, F.col("_offset") + F.col("_local"))
                  .drop("_key", "_from", "_task", "_local", "_offset"))
