"""Registered queries: writes, partitions, tables, versions, DML, views, expiry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import partitions as parts
from lakeops.operators.export import extract
from lakeops.operators.lifecycle import LifecycleRule, lifecycle
from lakeops.operators.sql import run_sql, store
from lakeops.operators.tables import (copy_tables, create_table, expire, table_metadata, write_table)
from lakeops.operators.versioned import Delete, Insert, Merge, Update, VersionedTable
from lakeops.operators.stored_query import StoredQueryView
from lakeops.operators.views import InlineFunction, MaterializedView, create_view
from lakeops.plans.fixtures import table
from lakeops.plans.registry import query
from lakeops.session import fresh_database, scratch_dir
from lakeops.sources.load import load

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# ---------------------------------------------------------------- writes

@query("write_append", "select * from nation union all select * from nation")
def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "append") + ".nation"
    write_table(table(spark, sf_dir, "nation"), name)
    write_table(table(spark, sf_dir, "nation"), name, create="CREATE_NEVER")
    return spark.table(name)


@query("write_truncate", "select * from orders where o_orderstatus = 'F'")
def write_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "truncate") + ".orders"
    orders = table(spark, sf_dir, "orders")
    write_table(orders, name, write="WRITE_EMPTY")
    write_table(orders.where("o_orderstatus = 'F'"), name, write="WRITE_TRUNCATE")
    return spark.table(name)


@query("write_with_field_addition", """
  select s_suppkey, s_name, null as s_acctbal from supplier
  union all select s_suppkey, s_name, s_acctbal from supplier""")
def write_with_field_addition(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "addition") + ".supplier"
    supplier = table(spark, sf_dir, "supplier")
    write_table(supplier.select("s_suppkey", "s_name"), name)
    write_table(supplier.select("s_suppkey", "s_name", "s_acctbal"), name,
                schema_update=["ALLOW_FIELD_ADDITION"])
    return spark.table(name)


@query("write_clustered", "select * from lineitem")
def write_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "clustered") + ".lineitem"
    write_table(table(spark, sf_dir, "lineitem"), name, cluster_by=["l_partkey", "l_suppkey"])
    return spark.table(name)


@query("write_interleaved", "select * from orders")
def write_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layout for filters on the customer, on the price or on the date alone."""
    name = fresh_database(spark, "interleaved") + ".orders"
    write_table(table(spark, sf_dir, "orders"), name, cluster_by=["o_custkey", "o_totalprice", "o_orderdate"], interleave=True)
    return spark.table(name)


def _extracted(df: DataFrame, fmt: str, **options) -> list[str]:
    base = scratch_dir(df.sparkSession, "extract")
    targets = [f"{base}/a-*", f"{base}/b-*"]
    extract(df, targets, fmt, **options)
    return [t.rstrip("*") for t in targets]


@query("extract_csv", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def extract_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    paths = _extracted(supplier, "csv", delimiter=";", compression="GZIP")
    return spark.read.schema(supplier.schema).option("sep", ";").option("header", True).csv(paths)


@query("extract_json", "select * from part")
def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return spark.read.schema(part.schema).json(_extracted(part, "json"))


@query("extract_parquet", "select * from orders")
def extract_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(*_extracted(table(spark, sf_dir, "orders"), "parquet", compression="SNAPPY"))


@query("store_result", "select count(*) as stored, count(*) as read_back from lineitem where l_returnflag = 'R'")
def store_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = store(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"))
    return spark.read.parquet(result.uri).agg(F.count(F.lit(1)).alias("read_back")).withColumn(
        "stored", F.lit(result.size).cast("bigint"))


# ---------------------------------------------------------------- partitions

def _partitioned(spark: SparkSession, sf_dir: str, granularity: str = "DAY") -> str:
    name = fresh_database(spark, "parts") + ".events"
    write_table(parts.partition_by_time(table(spark, sf_dir, "events"), "ts", granularity), name, partitioned=True)
    return name


@query("partitions_by_day", "select strftime(ts, '%Y%m%d') as partition_id, count(*) as rows from events group by 1")
def partitions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.count_partitions(spark.table(_partitioned(spark, sf_dir)))


@query("partitions_by_hour", "select strftime(ts, '%Y%m%d%H') as partition_id, count(*) as rows from events group by 1")
def partitions_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.count_partitions(parts.partition_by_time(table(spark, sf_dir, "events"), "ts", "HOUR"))


@query("partitions_by_range", """
  select case when o_custkey >= 0 and o_custkey < 1000 then cast(o_custkey // 100 * 100 as varchar)
              else '__UNPARTITIONED__' end as partition_id, count(*) as rows from orders group by 1""")
def partitions_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "ranges") + ".orders"
    write_table(parts.partition_by_range(table(spark, sf_dir, "orders"), "o_custkey", 0, 1000, 100),
                name, partitioned=True)
    return parts.count_partitions(spark.table(name))


@query("partitions_listed", "select distinct strftime(ts, '%Y%m%d') as partition_id from events")
def partitions_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts.list_partitions(spark, _partitioned(spark, sf_dir))


@query("partitions_selected_by_month", """
  select distinct strftime(o_orderdate, '%Y%m') as partition_id from orders
  where date_trunc('month', o_orderdate) between timestamp '1996-02-01' and timestamp '1997-04-04'""")
def partitions_selected_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = parts.partition_by_time(table(spark, sf_dir, "orders"), "o_orderdate", "MONTH")
    ids = parts.count_partitions(months).select(parts.PARTITION)
    return parts.select_partitions(ids, "MONTH", "1996-02-01T00:00:00", "1997-04-04T00:00")


@query("partitions_copied", """
  select *, strftime(ts, '%Y%m%d') as partition_id from events
  where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-08'""")
def partitions_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _partitioned(spark, sf_dir)
    target = fresh_database(spark, "copied") + ".events"
    parts.copy_partitions(spark, source, target, "DAY", "2024-01-05T00:00:00", "2024-01-07T00:00:00")
    return spark.table(target)


@query("partitions_deleted", """
  select *, strftime(ts, '%Y%m%d') as partition_id from events
  where not (ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20')""")
def partitions_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _partitioned(spark, sf_dir)
    parts.delete_partitions(spark, name, "DAY", "2024-01-05T00:00:00", "2024-01-19T00:00:00")
    return spark.table(name)


@query("partitions_expired", """
  select *, strftime(ts, '%Y%m%d') as partition_id from events where ts >= timestamp '2024-01-21'""")
def partitions_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _partitioned(spark, sf_dir)
    day = 86_400_000
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('lakeops.partition_ttl_ms' = '{10 * day}')")
    expire(spark, name.split(".")[0], now_ms=1_706_659_200_000)  # 2024-01-31 00:00 UTC
    return spark.table(name)


# ---------------------------------------------------------------- tables

@query("table_copied_from_many", "select * from nation union all select * from nation")
def table_copied_from_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "copies")
    for name in ("a", "b"):
        write_table(table(spark, sf_dir, "nation"), f"{database}.{name}")
    copy_tables(spark, [f"{database}.a", f"{database}.b"], f"{database}.both")
    return spark.table(f"{database}.both")


@query("table_copied_from_partitions", """
  select *, strftime(ts, '%Y%m%d') as partition_id from events
  where cast(ts as date) in (date '2024-01-03', date '2024-01-09')""")
def table_copied_from_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _partitioned(spark, sf_dir)
    target = fresh_database(spark, "copies") + ".two_days"
    copy_tables(spark, [f"{source}$20240103", f"{source}$20240109"], target)
    return spark.table(target)


@query("table_created_from_definition", """
  select o_orderkey, o_custkey as customer, o_totalprice as price, strftime(o_orderdate, '%Y') as partition_id from orders""")
def table_created_from_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_database(spark, "defined") + ".orders"
    create_table(spark, name, {
        "schema": {"fields": [{"name": "o_orderkey", "type": "INT64", "mode": "REQUIRED"},
                              {"name": "customer", "type": "INT64"}, {"name": "price", "type": "FLOAT64"}]},
        "partitioned": True, "clustering": ["customer"], "labels": {"team": "sales"},
        "description": "orders by year"})
    orders = parts.partition_by_time(table(spark, sf_dir, "orders"), "o_orderdate", "YEAR")
    write_table(orders.select("o_orderkey", F.col("o_custkey").alias("customer"),
                              F.col("o_totalprice").alias("price"), parts.PARTITION),
                name, partitioned=True, cluster_by=["customer"])
    return spark.table(name)


@query("table_metadata", " union all ".join(
    f"select '{t}' as table_name, count(*) as num_rows, 'EXTERNAL' as kind from {t}" for t in TABLES))
def metadata_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "metadata")
    frames = []
    for name in TABLES:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
        frames.append(table_metadata(spark, f"{database}.{name}"))
    return reduce(DataFrame.unionAll, frames).select(
        F.element_at(F.split("name", r"\."), -1).alias("table_name"), "num_rows", "kind")


@query("view_with_function", """
  select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as net from lineitem""")
def view_with_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "views")
    spark.sql(f"CREATE TABLE {database}.lineitem USING parquet LOCATION '{sf_dir}/lineitem.parquet'")
    create_view(spark, f"{database}.net_prices",
                f"SELECT l_orderkey, l_linenumber, {database}.net(l_extendedprice, l_discount) AS net FROM {database}.lineitem",
                [InlineFunction(f"{database}.net(price DOUBLE, discount DOUBLE) RETURNS DOUBLE RETURN price * (1 - discount)")])
    return spark.table(f"{database}.net_prices")


@query("materialized_view", """
  select cast(cast(ts as date) as varchar) as day, event_type, count(*) as n,
         cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents from events group by all""")
def materialized_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "base")
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    view = MaterializedView(
        spark, scratch_dir(spark, "mview"), base,
        {"day": "cast(to_date(ts) as string)", "event_type": "event_type"},
        {"n": "cast(1 as bigint)", "cents": "cast(round(value * 100) as bigint)"})
    hour = 3_600_000
    events.where(F.col("ts") < middle).write.parquet(base)
    view.refresh(now_ms=0)
    events.where(F.col("ts") >= middle).write.mode("append").parquet(base)
    view.refresh(now_ms=hour)
    return view.read()


_STORED = """select s_nationkey as nation, l_returnflag, avg(l_quantity) as mean_quantity, min(l_extendedprice) as least_price,
  max(l_discount) as most_discount, count(*) as n, cast(sum(l_quantity) as bigint) as quantity, {} as suppliers
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey where l_quantity > 5 group by s_nationkey, l_returnflag"""


@query("materialized_stored_query", _STORED.format("count(distinct l_suppkey)"))
def materialized_stored_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the join grow between refreshes, which read new files only."""
    parts = {"lineitem": (table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 3 == 0),
             "supplier": (table(spark, sf_dir, "supplier"), F.col("s_suppkey") % 4 == 0)}
    sources = {name: scratch_dir(spark, name) for name in parts}
    view = StoredQueryView(spark, scratch_dir(spark, "mview"), _STORED.format("approx_count_distinct(l_suppkey)"), sources, min_interval_ms=0)
    for name, (rows, late) in parts.items():
        rows.where(~late).write.parquet(sources[name])
    modes = [view.refresh(0)]
    for name, (rows, late) in parts.items():
        rows.where(late).write.mode("append").parquet(sources[name])
        modes.append(view.refresh(len(modes)))
    if modes != ["full", "incremental", "incremental"]:
        raise RuntimeError(f"refreshed as {modes}")
    return view.read()


# ---------------------------------------------------------------- versions and DML

def _orders(spark: SparkSession, sf_dir: str) -> VersionedTable:
    orders = table(spark, sf_dir, "orders")
    return VersionedTable.create(spark, scratch_dir(spark, "versions"),
                                 orders.withColumn("year", F.year("o_orderdate").cast("string")), "year")


ORDERS_SQL = "select *, cast(year(o_orderdate) as varchar) as year from orders"


@query("snapshot_and_restore", ORDERS_SQL)
def snapshot_and_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.snapshot("before")
    orders.execute(Delete("o_orderstatus = 'F'"))
    orders.restore(orders.snapshot_version("before"))
    return orders.read()


@query("sql_over_versions", """
  select o_orderstatus, count(*) as n, cast(0 as bigint) as deleted from orders where o_orderstatus <> 'F' group by 1
  union all select 'F', cast(0 as bigint), count(*) from orders where o_orderstatus = 'F'""")
def sql_over_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.execute(Delete("o_orderstatus = 'F'"))
    orders.register("orders_now")
    orders.register("orders_before", version=0)
    return run_sql(spark, """
        SELECT b.o_orderstatus, coalesce(n, 0L) AS n, before - coalesce(n, 0L) AS deleted
        FROM (SELECT o_orderstatus, count(*) AS before FROM orders_before GROUP BY 1) b
        LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders_now GROUP BY 1) a USING (o_orderstatus)""").rows


@query("clone_is_independent", f"with o as ({ORDERS_SQL}) select * from o where o_orderstatus <> 'F'")
def clone_is_independent(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    copy = orders.clone(scratch_dir(spark, "clone"))
    copy.execute(Delete("o_orderstatus = 'F'"))
    orders.execute(Delete("o_orderstatus = 'O'"))
    return copy.read()


@query("dml_update", f"""
  with o as ({ORDERS_SQL})
  select * replace (case when o_orderpriority = '1-URGENT' and year = '1997' then 0 else o_totalprice end as o_totalprice,
                    case when o_orderpriority = '1-URGENT' and year = '1997' then 'X' else o_orderstatus end as o_orderstatus) from o""")
def dml_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.execute(Update({"o_totalprice": "0", "o_orderstatus": "'X'"}, "o_orderpriority = '1-URGENT' AND year = '1997'"))
    return orders.read()


@query("dml_update_moves_partition", f"""
  with o as ({ORDERS_SQL}) select * replace (case when o_orderstatus = 'P' then '2030' else year end as year) from o""")
def dml_update_moves_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.execute(Update({"year": "'2030'"}, "o_orderstatus = 'P'"))
    return orders.read()


@query("dml_delete", f"with o as ({ORDERS_SQL}) select * from o where not (o_totalprice < 50000)")
def dml_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.execute(Delete("o_totalprice < 50000"))
    return orders.read()


@query("dml_merge", """
  select c_custkey, c_name, c_acctbal + coalesce(total, 0) as c_acctbal from customer
  left join (select o_custkey, sum(cast(round(o_totalprice) as bigint)) as total from orders group by 1)
    on o_custkey = c_custkey
  union all select -s_suppkey - 1, s_name, s_acctbal from supplier""")
def dml_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = VersionedTable.create(spark, scratch_dir(spark, "merge"), customer)
    totals = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("total"))
              .select("c_custkey", F.lit(None).cast("string").alias("c_name"), F.col("total").cast("double").alias("c_acctbal")))
    new = table(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"))
    target.execute(Merge(totals.unionByName(new), ["c_custkey"], {"c_acctbal": "c_acctbal + source.c_acctbal"}))
    return target.read()


@query("dml_batch_counts", """
  select 0 as step, count(*) as affected from orders where o_orderstatus = 'F'
  union all select 1, count(*) from orders where o_orderstatus <> 'F' and o_totalprice < 100000
  union all select 2, (select count(*) from supplier)""")
def dml_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    new = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("o_orderkey"), F.col("s_acctbal").alias("o_totalprice"), F.lit("2031").alias("year"))
    counts = orders.execute_batch([
        Update({"o_orderstatus": "'Z'"}, "o_orderstatus = 'F'"),
        Delete("o_orderstatus <> 'Z' AND o_totalprice < 100000"), Insert(new)])
    return spark.createDataFrame(list(enumerate(counts)), "step int, affected bigint")


@query("dml_batch_all_or_nothing", f"with o as ({ORDERS_SQL}) select * from o where o_orderstatus <> 'F'")
def dml_batch_all_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    orders.execute_batch([Delete("o_orderstatus = 'F'")])
    repeated = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    try:
        # several lines of one order make the second step fail
        orders.execute_batch([Delete("o_orderstatus = 'O'"),
                              Merge(repeated, ["o_orderkey"], {"o_totalprice": "0"})])
    except ValueError:
        pass
    return orders.read()


# ---------------------------------------------------------------- lifecycle

@query("object_lifecycle", """
  select event_id, date_diff('day', ts, timestamp '2024-01-31 00:00:00') - case when
           ts + to_days(cast(date_diff('day', ts, timestamp '2024-01-31 00:00:00') as int)) > timestamp '2024-01-31 00:00:00'
           then 1 else 0 end as age_days,
         case when ts <= timestamp '2024-01-11' then 'DELETE' when ts <= timestamp '2024-01-26' then 'SET_STORAGE_CLASS' end as due,
         case when ts <= timestamp '2024-01-11' then null when ts <= timestamp '2024-01-21' then 'COLDLINE'
              when ts <= timestamp '2024-01-26' then 'NEARLINE' end as target_class
  from events""")
def object_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("created"))
    rules = [LifecycleRule(20, "DELETE"), LifecycleRule(10, "SET_STORAGE_CLASS", "COLDLINE"),
             LifecycleRule(5, "SET_STORAGE_CLASS", "NEARLINE")]
    return lifecycle(objects, rules, F.to_timestamp(F.lit("2024-01-31 00:00:00"))).drop("created")


@query("load_into_partitioned_table", """
  select strftime(o_orderdate, '%Y') as partition_id, count(*) as rows from orders group by 1""")
def load_into_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").write.json(path)
    rows = load(spark, path, "json", {"fields": [
        {"name": "o_orderkey", "type": "INT64"}, {"name": "o_orderdate", "type": "DATETIME"}]}).rows
    name = fresh_database(spark, "loaded") + ".orders"
    write_table(parts.partition_by_time(rows, "o_orderdate", "YEAR"), name, partitioned=True)
    return parts.count_partitions(spark.table(name))
