"""Views of the given tables in the row forms the operators work on.

Each one reads a whole table and shapes it row by row, with the same text as SQL for the
side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.objects import object_uri


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # written as a pattern, the path may be a folder of files or a single file
    pattern = f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(pattern)


def micros(ts: str) -> F.Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def cells_of(events: DataFrame) -> DataFrame:
    """Wide-column cells, three per event, in two families."""
    cell = lambda family, qualifier, value: F.struct(
        F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"),
        F.col(value).cast("string").alias("value"))
    key = F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 4, "0"), F.lit("#"),
                   F.lpad(F.col("event_id").cast("string"), 8, "0"))
    return events.select(
        key.alias("row_key"), micros("ts").alias("timestamp"),
        F.inline(F.array(cell("cf1", "event_type", "event_type"), cell("cf1", "value", "value"),
                         cell("meta", "props", "props"))))


CELLS_SQL = """
  select 'u' || lpad(cast(user_id as varchar), 4, '0') || '#' || lpad(cast(event_id as varchar), 8, '0') as row_key,
         c.family as family, c.qualifier as qualifier, c.value as value, epoch_us(ts) as timestamp
  from (select user_id, event_id, ts, unnest([
          {'family': 'cf1', 'qualifier': 'event_type', 'value': event_type},
          {'family': 'cf1', 'qualifier': 'value', 'value': cast(value as varchar)},
          {'family': 'meta', 'qualifier': 'props', 'value': props}]) as c from events)"""


def objects_of(pages: DataFrame) -> DataFrame:
    """An object listing, one row per page."""
    name = F.regexp_replace("url", "^https?://[^/]+/", "")
    return pages.select(
        F.lit("bucket").alias("bucket"), name.alias("name"), F.col("page_id").alias("generation"),
        F.lit(1).cast("bigint").alias("metageneration"),
        F.octet_length("html").cast("bigint").alias("size"),
        F.base64(F.unhex(F.md5("html"))).alias("md5"),
        object_uri(F.lit("bucket"), name).alias("uri"))


OBJECTS_SQL = """
  select 'bucket' as bucket, regexp_replace(url, '^https?://[^/]+/', '') as name, page_id as generation,
         cast(1 as bigint) as metageneration, cast(strlen(html) as bigint) as size,
         'gs://bucket/' || replace(regexp_replace(url, '^https?://[^/]+/', ''), ' ', '+') as uri
  from pages"""


def messages_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("props").cast("binary").alias("data"),
        F.create_map(F.lit("event_type"), "event_type").alias("attributes"),
        F.col("event_id").cast("string").alias("message_id"),
        F.col("user_id").cast("string").alias("ordering_key"), F.col("event_id").alias("seq"))


def documents_of(customer: DataFrame) -> DataFrame:
    """JSON documents; accounts in debt have no ``segment`` field."""
    full = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                              F.col("c_nationkey").alias("nation")))
    bare = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")))
    return customer.select(
        F.col("c_custkey").cast("string").alias("doc_id"),
        F.when(F.col("c_acctbal") < 0, bare).otherwise(full).alias("data"))


def change_records_of(lineitem: DataFrame) -> DataFrame:
    """Nested change records: a shipment change and a child partition per order line."""
    change = F.struct(F.col("l_shipdate").cast("timestamp").alias("commit_ts"),
                      F.col("l_linestatus").alias("mod_type"), F.col("l_orderkey").alias("key"))
    child = F.struct(F.array(F.struct(
        F.concat(F.lit("t"), F.col("l_suppkey").cast("string")).alias("token"))).alias("child_partitions"))
    record = F.struct(F.array(change).alias("data_change_record"),
                      F.array(child).alias("child_partitions_record"))
    return lineitem.select(F.concat(F.lit("t"), F.col("l_suppkey").cast("string")).alias("partition_token"),
                           F.array(record).alias("ChangeRecord"))


def points_of(events: DataFrame) -> DataFrame:
    """Events as metric points, one series per event type and user."""
    return events.select(
        F.concat(F.lit("app/"), "event_type").alias("metric_type"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("labels"),
        F.lit("GAUGE").alias("kind"), "value",
        F.col("ts").cast("timestamp").alias("start_ts"), F.col("ts").cast("timestamp").alias("end_ts"))


def split_and_merged_records(orders: DataFrame) -> DataFrame:
    """Nested change records of four root partitions, eight children of those, and two that merge four each."""
    at, key = F.col("o_orderdate").cast("timestamp"), F.col("o_custkey")
    year = F.year("o_orderdate")
    token = (F.when(year < 1994, F.concat(F.lit("root"), (key % 4).cast("string")))
              .when(year < 1996, F.concat(F.lit("half"), (key % 8).cast("string")))
              .otherwise(F.concat(F.lit("whole"), (key % 2).cast("string"))))
    change = F.struct(at.alias("commit_ts"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("record_sequence"),
                      F.when(F.col("o_orderstatus") == "P", "DELETE").otherwise("UPDATE").alias("mod_type"),
                      key.alias("key"), F.col("o_totalprice").alias("value"))
    child = lambda name, parents: F.struct(name.alias("token"), parents.alias("parent_partition_tokens"))
    handed = lambda since, children: F.struct(F.lit(since).cast("timestamp").alias("start_timestamp"), children.alias("child_partitions"))
    no_child = F.array().cast("array<struct<start_timestamp:timestamp,child_partitions:array<struct<token:string,parent_partition_tokens:array<string>>>>>")
    data = orders.select(token.alias("partition_token"), F.array(F.struct(
        F.array(change).alias("data_change_record"), no_child.alias("child_partitions_record"))).alias("ChangeRecord"))
    digit = lambda text, n: F.concat(F.lit(text), (F.col("i") % n).cast("string"))
    spark, no_change = orders.sparkSession, F.array().cast(data.schema["ChangeRecord"].dataType.elementType["data_change_record"].dataType)
    half = handed("1994-01-01", F.array(child(digit("half", 8), F.array(digit("root", 4)))))
    parents = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: F.concat(F.lit("half"), (j * 2 + F.col("i") % 2).cast("string")))
    whole = handed("1996-01-01", F.array(child(digit("whole", 2), parents)))
    tree = [spark.range(8).withColumnRenamed("id", "i").select(reader.alias("partition_token"), F.array(F.struct(
        no_change.alias("data_change_record"), F.array(record).alias("child_partitions_record"))).alias("ChangeRecord"))
        for reader, record in ((digit("root", 4), half), (digit("half", 8), whole))]
    return data.unionByName(tree[0]).unionByName(tree[1])
