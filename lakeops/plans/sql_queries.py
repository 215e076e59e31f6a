"""Registered queries: SQL surface, cell forms, reports, text sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.functions import values
from lakeops.functions.labels import clean_label
from lakeops.operators import reports, sql, text
from lakeops.operators.tables import write_table
from lakeops.operators.interval_join import interval_join
from lakeops.operators.sketches import append_sketches, distinct_sketches, estimates, roll_up
from lakeops.plans.fixtures import table
from lakeops.plans.registry import query
from lakeops.session import fresh_database, scratch_dir

PRICING = """
  SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
         round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
  FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY l_returnflag, l_linestatus"""


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


#: Rows in one part of a table whose groups are nearly as many as its rows: a task holds those of every grouping set.
PART_ROWS = 500_000


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The same rows in parts of about ``PART_ROWS``, equal keys together, so that grouping keeps each part in memory."""
    return rows.repartition(max(1, -(-rows.count() // PART_ROWS)), key)


@query("sql_fetch", PRICING)
def sql_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "lineitem")
    return sql.run_sql(spark, PRICING).rows


JOINED = """
  SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total
  FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderstatus = 'F' GROUP BY n_name"""


@query("sql_store", JOINED)
def sql_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "customer", "orders", "nation")
    stored = sql.run_sql(spark, JOINED, "STORE")
    return spark.read.parquet(stored.uri)


@query("sql_store_count", "select count(*) as size from orders where o_totalprice > 100000")
def sql_store_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    stored = sql.run_sql(spark, "SELECT * FROM orders WHERE o_totalprice > 100000", "STORE")
    return spark.createDataFrame([(stored.size,)], "size bigint")


@query("sql_fetch_one", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1")
def sql_fetch_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return sql.run_sql(spark, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey",
                       "FETCH_ONE").rows


@query("sql_destination_table", """
  select c_mktsegment, count(*) as n from customer group by 1""")
def sql_destination_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "destination")
    _views(spark, sf_dir, "customer")
    sql.run_sql(spark, "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1", "NONE",
                destination=f"{database}.segments")
    return spark.table(f"{database}.segments")


@query("sql_script_last_result", """
  select event_type, count(*) as n from events where value > 100 group by 1""")
def sql_script_last_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "script")
    write_table(table(spark, sf_dir, "events"), f"{database}.events")
    return sql.run_sql(spark, """
        CREATE TABLE large USING parquet AS SELECT event_type FROM events WHERE value > 100;
        SELECT event_type, count(*) AS n FROM large GROUP BY event_type;""", default_dataset=database).rows


@query("sql_typed_parameters", """
  select event_id, user_id, event_type, value from events
  where user_id in (3, 5, 8, 13, 21) and ts >= timestamp '2024-01-10' and value >= 1.5 and event_type <> '@type'""")
def sql_typed_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime
    import decimal
    _views(spark, sf_dir, "events")
    return sql.run_sql(spark, """
        SELECT event_id, user_id, event_type, value FROM events
        WHERE user_id IN UNNEST(@ids) AND ts >= @since AND value >= @least AND event_type <> '@type'""",
        params={"ids": [3, 5, 8, 13, 21], "since": datetime.date(2024, 1, 10),
                "least": decimal.Decimal("1.5")}).rows


# ---------------------------------------------------------------- relational categories behind SQL

@query("sql_joins", """
  select p_brand, s_name, count(*) as lines, cast(sum(l_quantity) as bigint) as quantity
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'O')
    and not exists (select 1 from nation where n_nationkey = s_nationkey and n_regionkey = 0)
  group by p_brand, s_name""")
def sql_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "lineitem", "part", "supplier", "orders", "nation")
    return sql.run_sql(spark, """
        SELECT p_brand, s_name, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')
          AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = s_nationkey AND n_regionkey = 0)
        GROUP BY p_brand, s_name""").rows


@query("sql_rollup", """
  select o_orderstatus, o_orderpriority, count(*) as n from orders
  group by rollup (o_orderstatus, o_orderpriority)""")
def sql_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return sql.run_sql(spark, """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
        GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""").rows


@query("sql_grouping_sets", """
  select o_orderstatus, o_orderpriority, year(o_orderdate) as y, count(*) as n,
         cast(grouping(o_orderstatus) as int) as all_states from orders
  group by grouping sets ((o_orderstatus, y), (o_orderpriority), ())""")
def sql_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return sql.run_sql(spark, """
        WITH o AS (SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders)
        SELECT o_orderstatus, o_orderpriority, y, count(*) AS n, CAST(grouping(o_orderstatus) AS INT) AS all_states
        FROM o GROUP BY GROUPING SETS ((o_orderstatus, y), (o_orderpriority), ())""").rows


@query("sql_as_of_join", """
  with errors as (select * from events where event_type = 'error'),
  others as (select user_id, ts as last_ts, max(event_id) as last_id from events where event_type <> 'error' group by all)
  select e.event_id, o.last_ts, o.last_id from errors e asof left join others o on e.user_id = o.user_id and e.ts >= o.last_ts""")
def sql_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each error with the newest other event of its user: one sort by user and time, no range join."""
    _views(spark, sf_dir, "events")
    return sql.run_sql(spark, """
        WITH placed AS (
          SELECT event_id, event_type, max(CASE WHEN event_type <> 'error' THEN struct(ts, event_id) END) OVER (
            PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest
          FROM events)
        SELECT event_id, newest.ts AS last_ts, newest.event_id AS last_id FROM placed WHERE event_type = 'error'""").rows


@query("sql_window_top_per_group", """
  select * from (select o_custkey, o_orderkey, o_totalprice,
    cast(row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as int) as place from orders)
  where place <= 3""")
def sql_window_top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return sql.run_sql(spark, """
        SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
          SELECT o_custkey, o_orderkey, o_totalprice,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
        WHERE place <= 3""").rows


@query("sql_set_operations", """
  (select c_nationkey as k from customer intersect select s_nationkey from supplier)
  union all (select n_nationkey from nation except select s_nationkey from supplier)""")
def sql_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "customer", "supplier", "nation")
    return sql.run_sql(spark, """
        (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)
        UNION ALL (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)""").rows


@query("sql_cube_distinct", """
  select l_returnflag, l_linestatus, count(distinct l_orderkey) as orders, count(*) as n from lineitem
  group by cube (l_returnflag, l_linestatus)""")
def sql_cube_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread(table(spark, sf_dir, "lineitem"), "l_orderkey").createOrReplaceTempView("lineitem")
    return sql.run_sql(spark, """
        SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS orders, count(*) AS n FROM lineitem
        GROUP BY CUBE (l_returnflag, l_linestatus)""").rows


@query("sql_date_functions", """
  select strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as quarter, cast(floor(o_totalprice / 100000) + 1 as bigint) as band,
         count(*) as n, cast(sum(len(generate_series(1, month(o_orderdate)))) as bigint) as months
  from orders where o_totalprice < 500000 group by 1, 2""")
def sql_date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "orders")
    return sql.run_sql(spark, """
        SELECT date_format(date_trunc('QUARTER', o_orderdate), 'yyyy-MM-dd') AS quarter,
               width_bucket(o_totalprice, 0D, 500000D, 5) AS band, count(*) AS n,
               CAST(sum(size(sequence(1, month(o_orderdate)))) AS BIGINT) AS months
        FROM orders WHERE o_totalprice < 500000 GROUP BY 1, 2""").rows


@query("sql_constructors", """
  select event_id, event_type || '/' || user_id as joined, cast(json_extract(props, '$.k') as bigint) as k,
         epoch_us(ts + interval 1 day) as tomorrow, value as lon, -value as lat, user_id in (1, 2, 3) as early
  from events""")
def sql_constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    return sql.run_sql(spark, """
        SELECT event_id, array_join(array(s.kind, CAST(s.user AS STRING)), '/') AS joined,
               variant_get(j, '$.k', 'bigint') AS k, unix_micros(CAST(t.stop AS TIMESTAMP)) AS tomorrow,
               point[0] AS lon, point[1] AS lat, array_contains(@few, s.user) AS early
        FROM (SELECT event_id, named_struct('kind', event_type, 'user', user_id) AS s, parse_json(props) AS j,
                     named_struct('start', ts, 'stop', ts + INTERVAL 1 DAY) AS t, array(value, -value) AS point
              FROM events)""", params={"few": [1, 2, 3]}).rows


@query("sql_ddl_and_insert", """
  select o_orderpriority, count(*) as n from orders where o_orderstatus in ('F', 'P') group by 1""")
def sql_ddl_and_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark, "ddl")
    spark.sql(f"CREATE TABLE {database}.orders USING parquet LOCATION '{sf_dir}/orders.parquet'")
    return sql.run_sql(spark, """
        CREATE TABLE kept USING parquet PARTITIONED BY (o_orderpriority) AS
          SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F';
        INSERT INTO kept SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P';
        DROP TABLE IF EXISTS nothing_here;
        SELECT o_orderpriority, count(*) AS n FROM kept GROUP BY o_orderpriority""", default_dataset=database).rows


# ---------------------------------------------------------------- cells, flattening, paging

@query("normalise_cells", """
  select event_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(ts) % 1000000 = 0 then '' else strftime(ts, '.%f') end || 'Z' as at,
         value as lon, -value as lat, cast(json_extract(props, '$.k') as bigint) as k,
         strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S') || 'Z' as day_in_array,
         '0-0 ' || extract('day' from ts) || ' ' || extract('hour' from ts) || ':0:0' as gap, '1-' || (user_id % 12) || ' 0 0:0:0' as years
  from events""")
def normalise_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = lambda column, name, kind: F.col(column).alias(name, metadata={"declared": kind})
    events = table(spark, sf_dir, "events").withColumn(
        "point", F.concat(F.lit("POINT("), F.col("value").cast("string"), F.lit(" "),
                          (-F.col("value")).cast("string"), F.lit(")")))
    raw = events.select(
        "event_id", F.struct("ts").alias("when"),
        F.array(F.date_trunc("DAY", F.col("ts").cast("timestamp")).cast("timestamp_ntz")).alias("days"),
        declared("point", "place", "GEOGRAPHY"), declared("props", "props", "JSON"),
        F.make_dt_interval(F.dayofmonth("ts"), F.hour("ts")).alias("gap"),
        F.make_ym_interval(F.lit(1), (F.col("user_id") % 12).cast("int")).alias("years"))
    cells = values.normalise(raw)
    return cells.select(
        "event_id", F.col("when.ts").alias("at"), F.col("place")[0].alias("lon"), F.col("place")[1].alias("lat"),
        F.try_variant_get("props", "$.k", "bigint").alias("k"), F.col("days")[0].alias("day_in_array"),
        "gap", "years")


@query("encode_rows", """
  select o_orderkey, (((year(o_orderdate) * 16 + month(o_orderdate)) * 32 + day(o_orderdate)) << 37)
           + (cast(hour(o_orderdate) as bigint) << 32) + (minute(o_orderdate) << 26) + (second(o_orderdate) << 20) as civil,
         cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as int) as day,
         epoch_us(o_orderdate) as instant
  from orders""")
def encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderdate").alias("civil"), F.to_date("o_orderdate").alias("day")).alias("s"),
        F.array(F.col("o_orderdate").cast("timestamp")).alias("a"))
    return values.encode_rows(orders).select("o_orderkey", "s.civil", "s.day", F.col("a")[0].alias("instant"))


@query("encode_rows_in_milliseconds", """
  select event_id, epoch_us(ts) // 1000 * 1000 as instant,
         (((year(ts) * 16 + month(ts)) * 32 + day(ts)) << 37) + (cast(hour(ts) as bigint) << 32)
           + (minute(ts) << 26) + (second(ts) << 20) + epoch_us(ts) % 1000000 as civil
  from events""")
def encode_rows_in_milliseconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("instant"), F.col("ts").alias("civil"))
    return values.encode_rows(events, compat_millis=True)


@query("flatten_nested", """
  select l_orderkey as line_order, l_linenumber as line_number, m.name as measures_name, m.value as measures_value
  from (select l_orderkey, l_linenumber, unnest([
      {'name': 'quantity', 'value': l_quantity}, {'name': 'price', 'value': l_extendedprice},
      {'name': 'discount', 'value': l_discount}]) as m from lineitem)""")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = lambda name, column: F.struct(F.lit(name).alias("name"), F.col(column).alias("value"))
    nested = table(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("number")).alias("line"),
        F.array(measure("quantity", "l_quantity"), measure("price", "l_extendedprice"),
                measure("discount", "l_discount")).alias("measures"))
    return sql.flatten(nested)


@query("page_by_key", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 100 offset 200")
def page_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    last = None
    for _ in range(2):
        last = sql.next_page(orders, "o_orderkey", 100, last).agg(F.max("o_orderkey")).first()[0]
    return sql.next_page(orders, "o_orderkey", 100, last)


@query("page_numbers", """
  select o_orderkey, (row_number() over (order by o_orderkey) - 1) // 1000 + 1 as page from orders""")
def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql.number_pages(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1000)


@query("query_statistics", """
  select count(*) as rows, count(distinct strftime(ts, '%Y%m%d')) as partitions, 'purchases' as label
  from events where event_type = 'purchase' and value > 50""")
def query_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakeops.operators.partitions import PARTITION, partition_by_time
    events = partition_by_time(table(spark, sf_dir, "events"), "ts", "DAY")
    return sql.query_statistics(events.where("event_type = 'purchase' and value > 50"), PARTITION, "purchases")


@query("cost_report_by_label", """
  select lower(replace(event_type, '.', '_')) as label, count(*) as jobs, cast(sum(strlen(props)) as bigint) as bytes,
         case when sum(strlen(props)) >= 1048576 then printf('%.2f MB', sum(strlen(props)) / 1048576.0)
              when sum(strlen(props)) >= 1024 then printf('%.2f KB', sum(strlen(props)) / 1024.0)
              else sum(strlen(props)) || ' B' end as size,
         sum(strlen(props)) / 1099511627776.0 * 5 as cost_usd
  from events group by 1""")
def cost_report_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "events").withColumn("bytes", F.octet_length("props"))
    return reports.cost_report(jobs, "event_type", "bytes")


@query("label_text", """
  select c_custkey, left(lower(replace(repeat(c_name || '.', 4), '.', '_')), 63) as label from customer""")
def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_name = F.repeat(F.concat("c_name", F.lit(".")), 4)
    return table(spark, sf_dir, "customer").select("c_custkey", clean_label(long_name).alias("label"))


# ---------------------------------------------------------------- text sessions

@query("trim_history", """
  select conv_id, turn, role, text from (
    select *, sum(ceil(length(text) / 4.0)) over (partition by conv_id order by turn desc) as used from conversations)
  where used <= 200""")
def trim_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.trim_history(table(spark, sf_dir, "conversations"), 200)


@query("session_usage", """
  select conv_id,
         cast(sum(case when role <> 'assistant' then ceil(length(text) / 4.0) else 0 end) as bigint) as prompt_tokens,
         cast(sum(case when role = 'assistant' then ceil(length(text) / 4.0) else 0 end) as bigint) as candidate_tokens,
         cast(sum(ceil(length(text) / 4.0)) as bigint) as total_tokens,
         cast(sum(strlen(text)) as bigint) as serialized_bytes
  from conversations group by conv_id""")
def session_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.usage(table(spark, sf_dir, "conversations"), ["conv_id"])


@query("safety_rollup", """
  select doc_id, cast(0 as int) as part, cast(1 - quality as varchar) || ',' || cast(toxic as varchar) as scores,
         'LOW_QUALITY,TOXIC' as categories, toxic = 1 as blocked from labels""")
def safety_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = lambda category, score, blocked: F.struct(
        F.lit(category).alias("category"), score.alias("score"), blocked.alias("blocked"))
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.inline(F.array(
        rating("TOXIC", F.col("toxic"), F.col("toxic") == 1),
        rating("LOW_QUALITY", 1 - F.col("quality"), F.lit(False)))))
    found = text.safety(ratings)
    return found.select("doc_id", "part", F.array_join("scores", ",").alias("scores"),
                        F.array_join("categories", ",").alias("categories"), "blocked")


@query("run_observed", """
  select count(*) as rows, count(distinct cast(ts as date)) as partitions, cast(count_if(value > 100) as bigint) as dml_rows,
         'purchases' as label, true as timed from events where event_type = 'purchase' and value > 50""")
def run_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics that were gathered while the result was written."""
    events = table(spark, sf_dir, "events").where("event_type = 'purchase' and value > 50").withColumn("day", F.to_date("ts"))
    _, stats = sql.run_observed(events, partition_column="day", label="purchases", changed=F.col("value") > 100)
    return stats.frame(spark).select("rows", "partitions", "dml_rows", "label",
                                     ((F.col("seconds") > 0) & (F.col("bytes") > 0) & (F.col("files") > 0)).alias("timed"))


@query("sql_interval_join", """
  select s.event_type as opened, e.event_type, count(*) as n, cast(sum(e.event_id) as bigint) as ids
  from (select *, ts + to_minutes(cast(floor(value) as bigint) + 1) as until from events where event_type in ('signup', 'error')) s
  join events e on e.ts >= s.ts and e.ts < s.until group by all""")
def sql_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events within the minutes after a signup or error of anybody: an equi-join on bins, no nested loop, no pairs made."""
    events = table(spark, sf_dir, "events")
    opened = events.where("event_type in ('signup', 'error')").select(
        F.col("event_type").alias("opened"), F.col("ts").alias("since"), F.expr("ts + make_interval(0, 0, 0, 0, 0, cast(floor(value) as int) + 1)").alias("until"))
    points = events.select("event_type", "event_id", F.col("ts").alias("at"), F.expr("ts + interval 1 microsecond").alias("after"))
    return interval_join(opened, points, ("since", "until"), ("at", "after"), per=(["opened"], ["event_type"]),
                         sums={"ids": "right.event_id"})


@query("sql_distinct_rolled_up", """
  select strftime(ts, '%Y-%m') as month, event_type, count(*) as rows, count(distinct user_id) as users, true as close
  from events group by all""")
def sql_distinct_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of a month from stored sketches of its days, beside the exact count."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stored, half = scratch_dir(spark, "sketches"), F.col("event_id") % 2 == 0
    groups = {"day": "day", "event_type": "event_type"}
    # days grow while their rows come in; the sketches of both halves are merged
    append_sketches(distinct_sketches(events.where(half), groups, "user_id"),
                    distinct_sketches(events.where(~half), groups, "user_id")).write.parquet(stored)
    months = estimates(roll_up(spark.read.parquet(stored), {"month": "date_format(day, 'yyyy-MM')", "event_type": "event_type"}), "about")
    exact = events.groupBy(F.date_format("day", "yyyy-MM").alias("month"), "event_type").agg(F.count_distinct("user_id").alias("users"))
    return months.join(exact, ["month", "event_type"]).select(
        "month", "event_type", "rows", "users", (F.abs(F.col("about") - F.col("users")) <= 0.02 * F.col("users") + 1).alias("close"))


@query("sql_destination_in_ranges", """
  select case when user_id < 20 or user_id >= 100 then '__UNPARTITIONED__' else cast(user_id - user_id % 20 as varchar) end as part,
         count(*) as n from events group by 1""")
def sql_destination_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    out = sql.run_sql(spark, "SELECT event_id, user_id FROM events", destination=f"{fresh_database(spark, 'ranges')}.users",
                      partition_column="user_id", partition_range=(20, 100, 20))
    return out.rows.groupBy(F.col("partition_id").alias("part")).agg(F.count(F.lit(1)).alias("n"))
