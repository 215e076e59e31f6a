"""Registered queries: loads, external tables, listings, wide-column and document scans, series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.versioned import VersionedTable
from lakeops.plans.fixtures import (CELLS_SQL, OBJECTS_SQL, cells_of, documents_of, objects_of,
                                    points_of, table)
from lakeops.plans.registry import query
from lakeops.session import fresh_database, scratch_dir
from lakeops.sources import docs, objects, series, widecol
from lakeops.sources.load import CsvOptions, create_external_table, load, load_into

PIPE = "|"
NATION = {"fields": [
    {"name": "n_nationkey", "type": "INT64", "mode": "REQUIRED"},
    {"name": "n_name", "type": "STRING"}, {"name": "n_regionkey", "type": "INT64"}]}


def _csv_copy(df: DataFrame, **options) -> str:
    path = scratch_dir(df.sparkSession, "csv")
    df.write.options(sep=PIPE, escape='"', **options).csv(path)
    return path


@query("load_csv", """
  select cast(n_nationkey as bigint) as n_nationkey, n_name, cast(n_regionkey as bigint) as n_regionkey
  from nation""")
def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(table(spark, sf_dir, "nation"), header=True)
    return load(spark, path, "csv", NATION, csv=CsvOptions(delimiter=PIPE, skip_leading_rows=1)).rows


CUSTOMER = {"fields": [
    {"name": "c_custkey", "type": "INT64"}, {"name": "c_acctbal", "type": "NUMERIC"},
    {"name": "c_name", "type": "STRING"}, {"name": "c_mktsegment", "type": "STRING"}]}


def _dirty_customers(spark: SparkSession, sf_dir: str) -> str:
    """Text lines with three kinds of trouble: accounts in debt have no number for a balance,
    machinery customers lack the last field, building customers have one field too many."""
    balance = F.when(F.col("c_acctbal") < 0, "in debt").otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat_ws(PIPE, F.col("c_custkey").cast("string"), balance, "c_name")
    tail = (F.when(F.col("c_mktsegment") == "MACHINERY", "")
             .when(F.col("c_mktsegment") == "BUILDING", "|BUILDING|extra")
             .otherwise(F.concat(F.lit(PIPE), "c_mktsegment")))
    path = scratch_dir(spark, "dirty")
    table(spark, sf_dir, "customer").select(F.concat(line, tail)).write.text(path)
    return path


@query("load_csv_bad_record_budget", """
  select c_custkey, cast(c_acctbal as decimal(38,9)) as c_acctbal, c_name, c_mktsegment from customer
  where c_acctbal >= 0 and c_mktsegment not in ('MACHINERY', 'BUILDING')""")
def load_csv_bad_record_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = table(spark, sf_dir, "customer").count()
    return load(spark, _dirty_customers(spark, sf_dir), "csv", CUSTOMER,
                csv=CsvOptions(delimiter=PIPE), max_bad_records=everything).rows


@query("load_csv_jagged_and_unknown", """
  select c_custkey, cast(c_acctbal as decimal(38,9)) as c_acctbal, c_name,
         case when c_mktsegment <> 'MACHINERY' then c_mktsegment end as c_mktsegment
  from customer where c_acctbal >= 0""")
def load_csv_jagged_and_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = table(spark, sf_dir, "customer").count()
    return load(spark, _dirty_customers(spark, sf_dir), "csv", CUSTOMER,
                csv=CsvOptions(delimiter=PIPE, allow_jagged_rows=True),
                ignore_unknown_values=True, max_bad_records=everything).rows


@query("load_csv_quoted_newlines", "select doc_id, text from documents")
def load_csv_quoted_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # quoteAll keeps blank and null text apart; the writer must not trim
    path = _csv_copy(table(spark, sf_dir, "documents").select("doc_id", "text"), quoteAll=True,
                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    schema = {"fields": [{"name": "doc_id", "type": "INT64"}, {"name": "text", "type": "STRING"}]}
    return load(spark, path, "csv", schema,
                csv=CsvOptions(delimiter=PIPE, allow_quoted_newlines=True)).rows


@query("load_csv_leading_rows", "select p_partkey, p_name from part")
def load_csv_leading_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one file per 500 keys, each with two lines of comment in front
    part = table(spark, sf_dir, "part").withColumn("slot", F.floor(F.col("p_partkey") / 500))
    lines = part.select(F.concat_ws(PIPE, F.col("p_partkey").cast("string"), "p_name").alias("value"),
                        F.lit(2).alias("place"), "slot")
    heads = part.select("slot").distinct().select(
        F.posexplode(F.array(F.lit("# parts"), F.lit("# key and name"))).alias("place", "value"), "slot")
    path = scratch_dir(spark, "lead")
    (lines.unionByName(heads).repartition("slot").sortWithinPartitions("slot", "place")
          .select("value", "slot").write.partitionBy("slot").text(path))
    schema = {"fields": [{"name": "p_partkey", "type": "INT64"}, {"name": "p_name", "type": "STRING"}]}
    return load(spark, path, "csv", schema, csv=CsvOptions(delimiter=PIPE, skip_leading_rows=2)).rows


@query("load_json_lines", "select s_suppkey, s_name, cast(s_nationkey as bigint) as s_nationkey, s_acctbal from supplier")
def load_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    table(spark, sf_dir, "supplier").write.json(path)
    schema = {"fields": [
        {"name": "s_suppkey", "type": "INT64", "mode": "REQUIRED"}, {"name": "s_name", "type": "STRING"},
        {"name": "s_nationkey", "type": "INT64"}, {"name": "s_acctbal", "type": "FLOAT64"}]}
    return load(spark, path, "json", schema).rows


def _orders_with_extras(spark: SparkSession, sf_dir: str) -> str:
    """Urgent orders carry an unknown key inside their nested customer."""
    orders = table(spark, sf_dir, "orders")
    plain = F.struct(F.col("o_custkey").alias("key"))
    extra = F.struct(F.col("o_custkey").alias("key"), F.lit("call first").alias("hint"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    record = lambda customer: F.to_json(F.struct(
        "o_orderkey", F.col("o_orderstatus").alias("status"), customer.alias("customer")))
    path = scratch_dir(spark, "nested")
    orders.select(F.when(urgent, record(extra)).otherwise(record(plain))).write.text(path)
    return path


NESTED_ORDER = {"fields": [
    {"name": "o_orderkey", "type": "INT64", "mode": "REQUIRED"}, {"name": "status", "type": "STRING"},
    {"name": "customer", "type": "RECORD", "fields": [{"name": "key", "type": "INT64", "mode": "REQUIRED"}]}]}


@query("load_json_unknown_refused", """
  select o_orderkey, o_orderstatus as status, o_custkey as customer_key from orders
  where o_orderpriority <> '1-URGENT'""")
def load_json_unknown_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = table(spark, sf_dir, "orders").count()
    rows = load(spark, _orders_with_extras(spark, sf_dir), "json", NESTED_ORDER, max_bad_records=everything).rows
    return rows.select("o_orderkey", "status", F.col("customer.key").alias("customer_key"))


@query("load_json_unknown_ignored",
       "select o_orderkey, o_orderstatus as status, o_custkey as customer_key from orders")
def load_json_unknown_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, _orders_with_extras(spark, sf_dir), "json", NESTED_ORDER, ignore_unknown_values=True).rows
    return rows.select("o_orderkey", "status", F.col("customer.key").alias("customer_key"))


@query("load_parquet", "select * from region")
def load_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, f"{sf_dir}/region.parquet", "parquet").rows


@query("load_orc", "select * from part")
def load_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "orc")
    table(spark, sf_dir, "part").write.orc(path)
    return load(spark, path, "orc").rows


@query("load_by_glob", """
  select o_orderkey, o_totalprice from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')""")
def load_by_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "glob")
    orders = table(spark, sf_dir, "orders")
    (orders.withColumn("p", F.substring("o_orderpriority", 1, 3))
           .select("o_orderkey", "o_totalprice", "p").write.partitionBy("p").parquet(path))
    return load(spark, [f"{path}/p=1-*", f"{path}/p=2-H", f"{path}/p=5-*"], "parquet").rows


@query("load_declared_nested_schema", """
  select c_custkey, c_name as name, c_nationkey as nation, cast(c_acctbal as decimal(38,9)) as balance from customer""")
def load_declared_nested_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "nested")
    table(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(F.col("c_name").alias("name"), F.struct(
            F.col("c_nationkey").alias("nation"), F.array("c_acctbal").alias("balances")).alias("home"))
        .alias("profile")).write.json(path)
    schema = {"fields": [
        {"name": "c_custkey", "type": "INT64", "mode": "REQUIRED"},
        {"name": "profile", "type": "RECORD", "fields": [
            {"name": "name", "type": "STRING"},
            {"name": "home", "type": "RECORD", "fields": [
                {"name": "nation", "type": "INT64"},
                {"name": "balances", "type": "NUMERIC", "mode": "REPEATED"}]}]}]}
    rows = load(spark, path, "json", schema).rows
    return rows.select("c_custkey", "profile.name", F.col("profile.home.nation").cast("int").alias("nation"),
                       F.col("profile.home.balances")[0].alias("balance"))


@query("load_autodetect", """
  select column_name as name, case when column_type = 'VARCHAR' then 'string'
         when column_type in ('INTEGER', 'BIGINT') then 'int' when column_type = 'DOUBLE' then 'double' end as type
  from (describe part)""")
def load_autodetect(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(table(spark, sf_dir, "part"), header=True)
    got = load(spark, path, "csv", autodetect=True, csv=CsvOptions(delimiter=PIPE, skip_leading_rows=1))
    return spark.createDataFrame(got.rows.dtypes, "name string, type string")


@query("load_statistics", "select count(*) as output_rows, cast(0 as bigint) as bad_records from customer")
def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_copy(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name", "c_mktsegment"))
    return load(spark, path, "csv", CUSTOMER, csv=CsvOptions(delimiter=PIPE)).stats.select("output_rows", "bad_records")


@query("external_table_join", """
  select r_name, count(*) as nations from nation join region on n_regionkey = r_regionkey group by 1""")
def external_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "external")
    path = _csv_copy(table(spark, sf_dir, "region"), header=True, compression="gzip")
    create_external_table(
        spark, f"{database}.region", path, "csv", {"fields": [
            {"name": "r_regionkey", "type": "INT64"}, {"name": "r_name", "type": "STRING"}]},
        csv=CsvOptions(delimiter=PIPE, skip_leading_rows=1), compression="gzip")
    nation = table(spark, sf_dir, "nation")
    region = spark.table(f"{database}.region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
                  .groupBy("r_name").agg(F.count(F.lit(1)).alias("nations")))


@query("external_table_with_policy", """
  select c_custkey, cast(c_acctbal as decimal(38,9)) as c_acctbal from customer
  where c_acctbal >= 0 and c_mktsegment not in ('MACHINERY', 'BUILDING')""")
def external_table_with_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = "external_customers"
    create_external_table(spark, view, _dirty_customers(spark, sf_dir), "csv", CUSTOMER,
                          csv=CsvOptions(delimiter=PIPE), ignore_unknown_values=False, drop_bad_records=True)
    return spark.table(view).select("c_custkey", "c_acctbal")


@query("load_into_versioned_table", """
  select c_custkey, cast(c_acctbal as decimal(38,9)) as c_acctbal, c_mktsegment as segment from customer
  where c_acctbal >= 0 and c_mktsegment not in ('MACHINERY', 'BUILDING')""")
def load_into_versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = table(spark, sf_dir, "customer").count()
    kind = "c_custkey bigint, c_acctbal decimal(38,9), segment string"
    target = VersionedTable.create(spark, scratch_dir(spark, "versions"), spark.createDataFrame([], kind), "segment")
    load_into(target, _dirty_customers(spark, sf_dir), "csv", CUSTOMER, csv=CsvOptions(delimiter=PIPE),
              max_bad_records=everything, derive={"segment": F.col("c_mktsegment")})
    return target.read()


# ---------------------------------------------------------------- object listings

@query("objects_in_directory", f"""
  with o as ({OBJECTS_SQL}), n as (select distinct name from o)
  select case when instr(name, '/') > 0 then substr(name, 1, instr(name, '/')) else name end as name,
         instr(name, '/') > 0 as is_directory
  from n group by all""")
def objects_in_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = objects_of(table(spark, sf_dir, "pages"))
    return objects.list_objects(listing, max_files=None).select("name", "is_directory")


@query("objects_matching_regexp", f"""
  with o as ({OBJECTS_SQL})
  select name, max(generation) as generation, arg_max(size, generation) as size from o
  where regexp_full_match(uri, 'gs://bucket/en/[0-9]+.*') and not ends_with(name, '/') group by name""")
def objects_matching_regexp(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = objects_of(table(spark, sf_dir, "pages"))
    return objects.list_objects(listing, "en/", "RECURSIVE", "FILES", r"gs://bucket/en/[0-9]+.*",
                                max_files=None).select("name", "generation", "size")


@query("objects_all_versions_capped", f"""
  with o as ({OBJECTS_SQL}) select name, generation from o order by name, generation limit 25""")
def objects_all_versions_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = objects_of(table(spark, sf_dir, "pages"))
    return objects.list_objects(listing, listing_type="RECURSIVE", all_versions=True, max_files=25).select("name", "generation")


# ---------------------------------------------------------------- wide-column scans

@query("cells_by_prefix", f"""
  with c as ({CELLS_SQL}) select row_key, family, qualifier, value, timestamp from c
  where starts_with(row_key, 'u001')""")
def cells_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widecol.read_cells(cells_of(table(spark, sf_dir, "events")), prefix="u001")


@query("cells_by_range_family_limit", f"""
  with c as ({CELLS_SQL}), k as (
    select distinct row_key from c where family = 'cf1' and row_key >= 'u0003' and row_key < 'u0010'
    order by row_key limit 100)
  select row_key, family, qualifier, value, timestamp from c join k using (row_key) where family = 'cf1'""")
def cells_by_range_family_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widecol.read_cells(cells_of(table(spark, sf_dir, "events")), start="u0003", end="u0010",
                              family="cf1", limit=100)


@query("wide_rows_nested", f"""
  with c as ({CELLS_SQL})
  select row_key, cast(0 as int) as part,
         string_agg(family || ':' || qualifier || '=' || value, ';' order by family, qualifier) as cells
  from c group by row_key""")
def wide_rows_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = widecol.read_rows(cells_of(table(spark, sf_dir, "events")))
    text = F.transform("cells", lambda c: F.concat(c.family, F.lit(":"), c.qualifier, F.lit("="), c.value))
    return rows.select("row_key", "part", F.array_join(text, ";").alias("cells"))


@query("newest_cells", f"""
  with c as ({CELLS_SQL}), u as (select substr(row_key, 1, instr(row_key, '#') - 1) as row_key, family, qualifier,
         value, timestamp from c)
  select row_key, family, qualifier, arg_max(value, timestamp) as value, max(timestamp) as timestamp
  from u group by row_key, family, qualifier""")
def newest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = cells_of(table(spark, sf_dir, "events")).withColumn("row_key", F.substring_index("row_key", "#", 1))
    return widecol.newest_cells(cells)


# ---------------------------------------------------------------- documents

DOCUMENTS_SQL = """
  select cast(c_custkey as varchar) as doc_id, c_name as name, c_nationkey as nation,
         case when c_acctbal >= 0 then c_mktsegment end as segment from customer"""


def _as_columns(found: DataFrame) -> DataFrame:
    return found.select("doc_id", docs.doc_field("name").alias("name"),
                        docs.doc_field("nation", "int").alias("nation"),
                        docs.doc_field("segment").alias("segment"))


@query("document_by_id", f"with d as ({DOCUMENTS_SQL}) select * from d where doc_id = '42'")
def document_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_columns(docs.doc_get(documents_of(table(spark, sf_dir, "customer")), "42"))


@query("document_scan", f"with d as ({DOCUMENTS_SQL}) select * from d")
def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_columns(documents_of(table(spark, sf_dir, "customer")))


@query("document_query_missing_field", f"""
  with d as ({DOCUMENTS_SQL}) select * from d where segment <> 'BUILDING' and nation >= 10""")
def document_query_missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_columns(docs.doc_query(
        documents_of(table(spark, sf_dir, "customer")),
        [("segment", "NOT_EQUAL_TO", "BUILDING"), ("nation", "GREATER_THAN_OR_EQUAL_TO", 10)],
        types={"nation": "int"}))


@query("document_query_null", f"with d as ({DOCUMENTS_SQL}) select * from d where segment is null")
def document_query_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_columns(docs.doc_query(documents_of(table(spark, sf_dir, "customer")),
                                      [("segment", "EQUAL_TO", None)]))


@query("document_query_page", f"""
  with d as ({DOCUMENTS_SQL}) select * from d where segment = 'HOUSEHOLD'
  order by name desc, doc_id desc limit 20 offset 10""")
def document_query_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_columns(docs.doc_query(documents_of(table(spark, sf_dir, "customer")),
                                      [("segment", "EQUAL_TO", "HOUSEHOLD")], "name", "DESCENDING", 10, 20))


# ---------------------------------------------------------------- series

@query("series_look_back", """
  select 'app/' || event_type as metric_type, cast(user_id as varchar) as user_label, cast(0 as int) as part,
         count(*) as points, arg_min(value, ts) as first_value, arg_max(value, ts) as last_value
  from events where event_type in ('error', 'purchase')
    and ts between timestamp '2024-01-20 00:00:00' - interval 7 day and timestamp '2024-01-20 00:00:00'
  group by event_type, user_id""")
def series_look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.query_series(
        points_of(table(spark, sf_dir, "events")), "metric_type in ('app/error', 'app/purchase')",
        F.to_timestamp(F.lit("2024-01-20 00:00:00")), "INTERVAL 7 DAYS")
    return found.select(
        "metric_type", F.col("labels")["user"].alias("user_label"), "part",
        F.size("points").cast("bigint").alias("points"), F.col("points")[0]["value"].alias("first_value"),
        F.element_at("points", -1)["value"].alias("last_value"))
