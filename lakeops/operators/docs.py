"""Writes and deletes on document collections (see ``lakeops.sources.docs``), as frames and as stored folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from lakeops.operators.skew import join_small
from lakeops.session import delete_path, materialise, path_exists, put_json_if_absent, read_json


def prepare_docs(new: DataFrame) -> DataFrame:
    """``doc_id`` and JSON text: maps and structs are encoded, null becomes ``{}``, a missing
    id is generated. Generated ids are written down once, so a retried task cannot change them."""
    kind = new.schema["data"].dataType
    data = F.col("data") if isinstance(kind, T.StringType) else F.to_json("data")
    docs = new.withColumn("data", F.coalesce(data, F.lit("{}")))
    if "doc_id" not in new.columns:
        docs = docs.withColumn("doc_id", F.lit(None).cast("string"))
    return materialise(docs.withColumn("doc_id", F.coalesce("doc_id", F.uuid())), "docs")


def doc_set(docs: DataFrame, new: DataFrame) -> DataFrame:
    """The collection after full replacement by id. With several new documents of one id the
    highest ``seq`` wins; without ``seq`` that is an error."""
    prepared = prepare_docs(new)
    if "seq" in prepared.columns:
        prepared = prepared.groupBy("doc_id").agg(F.max_by("data", "seq").alias("data"))
    elif prepared.groupBy("doc_id").count().where("count > 1").head(1):
        raise ValueError("several new documents have one id; give their order in seq")
    prepared = prepared.select("doc_id", "data")
    return docs.select("doc_id", "data").join(prepared, "doc_id", "left_anti").unionByName(prepared)


def doc_delete(docs: DataFrame, doc_ids: list[str] | DataFrame) -> DataFrame:
    if isinstance(doc_ids, DataFrame):
        return docs.join(doc_ids, "doc_id", "left_anti")
    return docs.where(~F.col("doc_id").isin(list(doc_ids)))


class DocCollection:
    """A stored collection: Parquet in one folder for each bucket of a hash of the id.

    A change finds the buckets that it touches, rewrites those and leaves all others alone; Spark replaces their folders when
    the new files are complete, so a change that fails earlier leaves the collection as it was. There is one writer at a
    time. The number of buckets is fixed when the collection is made: take it so that a bucket is a file of usual size.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        settings = f"{self.path}/_settings/collection.json"
        if not path_exists(spark, settings):
            put_json_if_absent(spark, settings, {"buckets": buckets})
        self.buckets = read_json(spark, settings)["buckets"]

    _SCHEMA = "doc_id string, data string, bucket int"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._SCHEMA).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def set(self, new: DataFrame) -> int:
        """Replace documents by id, or add them, as ``doc_set`` does; returns how many were written."""
        prepared = prepare_docs(new)
        ids = prepared.select(F.col("doc_id").cast("string").alias("doc_id")).distinct()
        self._rewrite(ids, lambda old: doc_set(old, prepared))
        return ids.count()

    def delete(self, doc_ids: list[str] | DataFrame) -> int:
        """Remove documents by id; returns how many there were."""
        ids = doc_ids if isinstance(doc_ids, DataFrame) else self.spark.createDataFrame([(i,) for i in doc_ids], "doc_id string")
        ids = materialise(ids.select(F.col("doc_id").cast("string").alias("doc_id")).distinct(), "doc_ids")
        before = materialise(self._touched(ids).join(ids, "doc_id", "left_semi").select("doc_id"), "doc_ids")
        self._rewrite(before, lambda old: old.join(before, "doc_id", "left_anti"))
        return before.count()

    def _touched(self, ids: DataFrame) -> DataFrame:
        touched = materialise(ids.select(self._bucket().alias("bucket")).distinct(), "buckets")
        return join_small(self._stored(), touched, ["bucket"], "left_semi")

    def _rewrite(self, ids: DataFrame, change) -> None:
        # numbers of buckets: at most as many as the collection has
        touched = [r[0] for r in ids.select(self._bucket()).distinct().collect()]
        old = self._stored().where(F.col("bucket").isin(touched)).drop("bucket")
        after = materialise(change(old).select(F.col("doc_id").cast("string").alias("doc_id"), "data")
                            .withColumn("bucket", self._bucket()), "collection")
        (after.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("bucket").parquet(self.path))
        left = {r[0] for r in after.select("bucket").distinct().collect()}
        for bucket in set(touched) - left:
            delete_path(self.spark, f"{self.path}/bucket={bucket}")
