"""Publishing and consuming messages over a file sink and source.

Offsets in the checkpoint take the place of acknowledgements: a batch counts as taken once its
output is written, and a failed batch is delivered again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.session import delete_path, list_names, path_exists, put_json_if_absent, read_json, scratch_dir
from lakeops.sources.messages import check_serde, decode, encode_payload


# Spark fills the low 33 bits of monotonically_increasing_id with the row's place in its task.
_ROW_BITS = 33


@dataclass
class Consumed:
    rows: DataFrame
    count: int
    uri: str


def publish(df: DataFrame, path: str, serde: str = "STRING", order: str = "seq") -> int:
    """Encode and append messages; returns their number.

    If any message has a non-blank ordering key, output is sorted by key and ``order`` over a
    range partitioning: a key's messages stay in order along the part files, and a key with
    very many messages simply covers several files.
    """
    keep = ["data", "attributes", "message_id", "ordering_key", *([order] if order in df.columns else [])]
    # written down once: ids that are drawn here must be the same in the sample, the shuffle and a repeated task
    staged = scratch_dir(df.sparkSession, "encoded")
    _encoded(df, serde).select(*keep).write.parquet(staged)
    encoded = df.sparkSession.read.parquet(staged)
    total = encoded.count()
    if order in keep and encoded.where(F.trim("ordering_key") != "").select("ordering_key").head(1):
        encoded = encoded.repartitionByRange("ordering_key", order).sortWithinPartitions("ordering_key", order)
    encoded.write.mode("append").parquet(path)
    delete_path(df.sparkSession, staged)
    return total


def _encoded(df: DataFrame, serde: str) -> DataFrame:
    check_serde(serde)
    encoded = df.withColumn("data", encode_payload(F.col("data"), df.schema["data"].dataType, serde))
    for name, kind in (("attributes", "map<string,string>"), ("message_id", "string"), ("ordering_key", "string")):
        if name not in df.columns:
            encoded = encoded.withColumn(name, F.lit(None).cast(kind))
    return encoded.withColumn("message_id", F.coalesce("message_id", F.uuid()))


def publish_kafka(df: DataFrame, topic: str, options: dict[str, str], serde: str = "STRING") -> int:
    """The same messages to a Kafka topic: the ordering key is the record key, attributes and
    message id are headers."""
    header = F.transform(F.map_entries(F.coalesce("attributes", F.create_map().cast("map<string,string>"))),
                         lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    own = F.array(F.struct(F.lit("message_id").alias("key"), F.col("message_id").cast("binary").alias("value")))
    records = _encoded(df, serde).select(
        F.col("ordering_key").alias("key"), F.col("data").alias("value"), F.concat(header, own).alias("headers"))
    try:
        records.write.format("kafka").options(**options).option("topic", topic).option(
            "includeHeaders", "true").save()
    except AnalysisException as error:
        raise RuntimeError("Kafka topics need the spark-sql-kafka package on the classpath") from error
    return df.count()


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A Kafka stream in message form; the record position stands in for a missing message id."""
    try:
        records = spark.readStream.format("kafka").options(**options).option("includeHeaders", "true").load()
    except AnalysisException as error:
        raise RuntimeError("Kafka topics need the spark-sql-kafka package on the classpath") from error
    headers = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return records.select(F.col("value").alias("data"), headers.alias("attributes"), "key", place.alias("place")).select(
        "data", F.map_filter("attributes", lambda k, _: k != "message_id").alias("attributes"),
        F.coalesce(F.col("attributes")["message_id"], "place").alias("message_id"),
        F.col("key").cast("string").alias("ordering_key"))


def consume_batch(messages: DataFrame, serde: str = "STRING", max_records: int | None = None,
                  max_duration: float | None = None, checkpoint: str | None = None,
                  path: str | None = None) -> Consumed:
    """Take what is there from a stream (or a static frame), decode it, write it to files.

    At least one bound is needed, and ``max_records`` is exact. Micro-batches are spooled below the checkpoint; what a batch
    holds beyond the bound is what the next call with the same checkpoint takes first. A call's messages count as taken
    when its pointer into the spool is written, after its output: a call that fails earlier leaves all to the next.
    Of a static frame the first rows are taken, counted in the order of its files.
    """
    if max_records is None and max_duration is None:
        raise ValueError("give max_records, max_duration or both")
    spark = messages.sparkSession
    path = path or scratch_dir(spark, "consumed")
    decoded = decode(messages, serde)
    if check_serde(serde) == "JSON":
        decoded = decoded.withColumn("data", F.to_json("data"))
    if not messages.isStreaming:
        (decoded if max_records is None else _first_rows(decoded, max_records)).write.parquet(path)
        rows = spark.read.parquet(path)
        return Consumed(rows, rows.count(), path)
    checkpoint = checkpoint or scratch_dir(spark, "checkpoint")
    spool = _Spool(spark, f"{checkpoint}/spool", decoded.schema)
    waiting = spool.waiting()

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal waiting
        if max_records is not None and waiting >= max_records:
            # not spooled and not committed: the offsets stay open for the next call
            raise _Enough()
        waiting += spool.put(batch, batch_id)

    if max_records is None or waiting < max_records:
        query = (decoded.writeStream.foreachBatch(write).trigger(availableNow=True)
                        .option("checkpointLocation", checkpoint).start())
        try:
            finished = query.awaitTermination(max_duration) if max_duration else query.awaitTermination()
        except Exception as error:
            if _Enough.__name__ not in str(error):
                raise
            finished = True
        if max_duration and not finished:
            query.stop()
    return Consumed(*spool.take(max_records, path), path)


def _lines(numbered: DataFrame) -> list[tuple[int, int]]:
    """First number and count of the rows of each task that numbered them, one line a task."""
    found = numbered.groupBy(F.shiftright("_id", _ROW_BITS).alias("task")).agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return sorted((r["first"], r["n"]) for r in found.collect())


def _cut(lines: list[tuple[int, int]], wanted: int) -> tuple[int, int | None]:
    """How many rows come before the cut, and the number of the first row after it, None where all do."""
    taken = 0
    for first, n in lines:
        if taken + n > wanted:
            return wanted, first + wanted - taken
        taken += n
    return taken, None


def _first_rows(df: DataFrame, wanted: int) -> DataFrame:
    """So many rows, by the order of files and tasks: no task sees more than its own."""
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    _, stop = _cut(_lines(numbered), wanted)
    return (numbered if stop is None else numbered.where(F.col("_id") < stop)).drop("_id")


class _Spool:
    """Micro-batches with numbered rows, and pointers behind the last row that each call took."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path
        self.schema = T.StructType([*schema.fields, T.StructField("_id", T.LongType())])

    def pointer(self) -> dict:
        names = list_names(self.spark, f"{self.path}/pointers")
        return read_json(self.spark, f"{self.path}/pointers/{names[-1]}") if names else {"call": -1, "batch": -1, "next": 0}

    def put(self, batch: DataFrame, batch_id: int) -> int:
        """Keep a batch; returns the rows that were not there before."""
        place = f"{self.path}/batch={batch_id}"
        # a batch that is handed over again is the one that is there, whose rows may be taken in part
        if path_exists(self.spark, f"{place}/_SUCCESS"):
            return 0
        batch.withColumn("_id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(place)
        return sum(n for _, n in self.lines(batch_id, self.pointer()))

    def numbers(self, pointer: dict) -> list[int]:
        found = [int(n.split("=")[1]) for n in list_names(self.spark, self.path, dirs_only=True) if n.startswith("batch=")]
        return sorted(n for n in found if n >= pointer["batch"] and path_exists(self.spark, f"{self.path}/batch={n}/_SUCCESS"))

    def rows(self, number: int, pointer: dict) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={number}")
        if number > pointer["batch"]:
            return rows
        return rows.limit(0) if pointer["next"] is None else rows.where(F.col("_id") >= pointer["next"])

    def lines(self, number: int, pointer: dict) -> list[tuple[int, int]]:
        return [] if number < pointer["batch"] else _lines(self.rows(number, pointer))

    def waiting(self) -> int:
        pointer = self.pointer()
        return sum(n for number in self.numbers(pointer) for _, n in self.lines(number, pointer))

    def take(self, wanted: int | None, path: str) -> tuple[DataFrame, int]:
        """Write the next rows to ``path``, move the pointer behind them, and drop batches that are used up."""
        pointer, total, parts = self.pointer(), 0, []
        after = {**pointer, "call": pointer["call"] + 1}
        for number in self.numbers(pointer):
            if wanted is not None and total >= wanted:
                break
            lines = self.lines(number, pointer)
            n, stop = _cut(lines, wanted - total) if wanted is not None else (sum(x for _, x in lines), None)
            rows = self.rows(number, pointer)
            parts.append(rows if stop is None else rows.where(F.col("_id") < stop))
            total, after = total + n, {**after, "batch": number, "next": stop}
        taken = reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)
        taken.drop("_id").write.parquet(path)
        put_json_if_absent(self.spark, f"{self.path}/pointers/{after['call']:012d}.json", after)
        for name in list_names(self.spark, self.path, dirs_only=True):
            if name.startswith("batch=") and int(name.split("=")[1]) < after["batch"]:
                delete_path(self.spark, f"{self.path}/{name}")
        return self.spark.read.schema(self.schema).parquet(path).drop("_id"), total


class _Enough(Exception):
    """Raised between micro-batches once the record bound is reached."""


def consume_stream(messages: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                   serde: str = "STRING", interval: str | None = "1 second") -> StreamingQuery:
    """Hand every decoded micro-batch to ``handler`` until the query is stopped.

    ``interval=None`` drains what is available and ends. A batch may be handed over again
    after a failure, with the same batch id.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (decode(messages, serde).writeStream.foreachBatch(handler).trigger(**trigger)
            .option("checkpointLocation", checkpoint).start())


def poll(messages: DataFrame, serde: str = "STRING", max_records: int | None = None,
         max_duration: float | None = None, checkpoint: str | None = None) -> Consumed | None:
    """The polling form: a result only when at least one message came."""
    got = consume_batch(messages, serde, max_records, max_duration, checkpoint)
    return got if got.count else None
