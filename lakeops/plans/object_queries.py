"""Registered queries: bulk object jobs over files written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import checksum
from lakeops.operators import object_jobs as jobs
from lakeops.operators.skew import number_rows
from lakeops.plans.fixtures import table
from lakeops.plans.registry import query
from lakeops.session import list_names, scratch_dir
from lakeops.sources.load import input_files
from lakeops.sources.objects import scan_folder

FILE_BYTES = 128 * 1024 * 1024
TEXT_SQL = "select doc_id, md5(text) as digest from documents"


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.md5("text").alias("digest"))


def _document_files(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Documents as JSON files, and the listing of those files."""
    path = scratch_dir(spark, "objects")
    size = input_files(spark, [f"{sf_dir}/documents.parquet"]).agg(F.sum("length")).first()[0]
    files = max(8, size // FILE_BYTES)
    table(spark, sf_dir, "documents").select("doc_id", "text").repartition(files).write.json(path)
    return path, scan_folder(spark, path).where(F.col("name").endswith(".json"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, text string").json(path)


@query("objects_composed", TEXT_SQL)
def objects_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, listing = _document_files(spark, sf_dir)
    out = scratch_dir(spark, "composed")
    # every 32 files in name order make one object
    parts = number_rows(listing, ["name"], "position").select(
        F.concat(F.lit(f"{out}/joined-"), F.floor(F.col("position") / jobs.COMPOSE_PARTS).cast("string"),
                 F.lit(".json")).alias("target"), "position", "location")
    jobs.compose(parts)
    return _digests(_read(spark, out))


@query("objects_copied", TEXT_SQL)
def objects_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, listing = _document_files(spark, sf_dir)
    out = scratch_dir(spark, "copied")
    jobs.transfer(listing, "COPY", out)
    return _digests(_read(spark, out))


@query("objects_moved", "select count(*) as rows, cast(0 as int) as left_behind from documents")
def objects_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, listing = _document_files(spark, sf_dir)
    out = scratch_dir(spark, "moved")
    jobs.transfer(listing, "MOVE", out)
    left = sum(1 for n in list_names(spark, path) if n.endswith(".json"))
    return _read(spark, out).agg(F.count(F.lit(1)).alias("rows")).withColumn("left_behind", F.lit(left))


@query("objects_deleted", "select true as all_deleted, true as all_bytes, count(*) as rows from documents")
def objects_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, listing = _document_files(spark, sf_dir)
    rows = _read(spark, path).count()
    before = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    deleted = jobs.delete_objects(listing, error_on_empty=True)
    left = sum(1 for n in list_names(spark, path) if n.endswith(".json"))
    return deleted.select(((F.col("count") == before["n"]) & F.lit(left == 0)).alias("all_deleted"),
                          (F.col("bytes") == before["size"]).alias("all_bytes"), F.lit(rows).cast("bigint").alias("rows"))


@query("checksum_manifest", "select doc_id, to_base64(unhex(md5(text))) as md5 from documents")
def checksum_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", checksum.md5(F.col("text")).alias("md5"))


#: The CRC of each of the 256 bytes, worked out from the polynomial, and the register run over a text's bytes.
CRC32C_SQL = """
  with steps as (
    select list_reduce(list_prepend(b::bigint, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 2197175160) else c >> 1 end) as c, b
    from range(256) t(b)),
  k as (select list(c order by b) as k from steps),
  d as materialized (select doc_id, hex(encode(text)) as h from documents)
  select doc_id, to_base64(unhex(printf('%08x', xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, (length(h) // 2 + 1)::bigint),
                 lambda i: ('0x' || substr(h, 2 * i - 1, 2))::bigint)),
    lambda c, b: xor(k[(xor(c, b) & 255) + 1], c >> 8)))))) as crc32c
  from d, k"""


@query("checksum_crc32c", CRC32C_SQL)
def checksum_crc32c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", checksum.crc32c(F.col("text")).alias("crc32c"))


@query("checksum_mismatches", """
  select page_id, 'checksum' as reason from pages where page_id % 3 = 0 and html like '%<p>%'""")
def checksum_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page is damaged in the copy: characters change, the length does not."""
    pages = table(spark, sf_dir, "pages")
    sums = lambda text: (F.octet_length(text).cast("bigint").alias("size"),
                         checksum.crc32c(text).alias("crc32c"), checksum.md5(text).alias("md5"))
    damaged = F.when(F.col("page_id") % 3 == 0,
                     F.replace(F.col("html"), F.lit("<p>"), F.lit("<q>"))).otherwise(F.col("html"))
    expected = pages.select("page_id", *sums(F.col("html")))
    return jobs.mismatches(pages.select("page_id", *sums(damaged)), expected, "page_id")


@query("objects_staged", TEXT_SQL)
def objects_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, listing = _document_files(spark, sf_dir)
    out = scratch_dir(spark, "staged")
    jobs.stage_in(listing, out, "DELETE")
    return _digests(_read(spark, out))
