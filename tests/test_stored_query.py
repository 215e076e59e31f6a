"""Materialized views over stored queries: refreshed from new files, equal to the query itself."""

import uuid

import pytest

from lakeops.operators.stored_query import StateQuery, StoredQueryView

QUERY = """SELECT c.region AS region, s.kind, avg(s.amount) AS mean_amount, min(s.amount) AS least, max(s.amount * 2) AS most,
  count(*) AS n, count(s.amount) AS n_amounts, approx_count_distinct(s.buyer) AS buyers, sum(s.amount) / count(*) AS per_row
FROM sales s JOIN shops c ON s.shop = c.shop WHERE s.amount IS NULL OR s.amount > -50 GROUP BY c.region, s.kind"""


def sales(spark, start, stop):
    return spark.range(start, stop).selectExpr(
        "cast(id % 7 as int) as shop", "concat('k', id % 3) as kind",
        "case when id % 11 = 0 then null else cast((id * 37) % 101 - 60 as decimal(10, 2)) end as amount", "id % 90 as buyer")


def shops(spark, *numbers):
    return spark.createDataFrame([(n, f"r{n % 2}") for n in numbers], "shop int, region string")


def rows(df):
    return sorted(map(str, df.collect()))


def check(spark, view, exact="buyers"):
    """As a new view that reads everything; and as the query, whose own sketch is another one."""
    whole = StoredQueryView(spark, f"{view.path}-{uuid.uuid4().hex}", view.query, view.sources)
    assert whole.refresh(0) == "full"
    plain = plainly(spark, view)
    assert rows(view.read()) == rows(whole.read())
    assert rows(view.read().drop(exact)) == rows(plain.drop(exact))
    assert view.read().schema.simpleString() == plain.schema.simpleString()
    if "buyers" in plain.columns:
        exact_count = spark.sql(view.query.replace("approx_count_distinct(", "count(DISTINCT "))
        assert rows(view.read().select("region", "kind", "buyers")) == rows(exact_count.select("region", "kind", "buyers"))


@pytest.fixture
def view(spark, folder):
    sales(spark, 0, 300).write.parquet(f"{folder}/sales")
    shops(spark, 0, 1, 2).write.parquet(f"{folder}/shops")
    return StoredQueryView(spark, f"{folder}/view", QUERY, {"sales": f"{folder}/sales", "shops": f"{folder}/shops"}, min_interval_ms=1_000)


def plainly(spark, view):
    for name, path in view.sources.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.sql(view.query)


def test_new_files_of_either_side_or_both(spark, view):
    assert view.refresh(0) == "full"
    check(spark, view)
    sales(spark, 300, 500).write.mode("append").parquet(view.sources["sales"])
    assert view.refresh(500) == "too_soon"
    assert view.refresh(2_000) == "incremental"
    check(spark, view)
    shops(spark, 3, 4).write.mode("append").parquet(view.sources["shops"])
    assert view.refresh(4_000) == "incremental"
    check(spark, view)
    sales(spark, 500, 900).write.mode("append").parquet(view.sources["sales"])
    shops(spark, 5, 6).write.mode("append").parquet(view.sources["shops"])
    assert view.refresh(6_000) == "incremental"
    check(spark, view)
    assert view.refresh(8_000) == "unchanged"


def test_many_new_files_are_selected_by_a_join(spark, view, monkeypatch):
    monkeypatch.setattr("lakeops.operators.stored_query.MAX_PATHS", 1)
    view.refresh(0)
    sales(spark, 300, 500).repartition(4).write.mode("append").parquet(view.sources["sales"])
    assert view.refresh(2_000) == "incremental"
    check(spark, view)


def test_rewritten_files_and_outer_joins_are_computed_again(spark, view, folder):
    view.refresh(0)
    sales(spark, 0, 40).write.mode("overwrite").parquet(view.sources["sales"])
    assert view.refresh(2_000) == "full"
    check(spark, view)
    outer = StoredQueryView(spark, f"{folder}/outer", QUERY.replace("JOIN", "LEFT JOIN"), view.sources, min_interval_ms=0)
    outer.refresh(0)
    sales(spark, 40, 90).write.mode("append").parquet(view.sources["sales"])
    assert outer.refresh(1) == "incremental"
    check(spark, outer)
    shops(spark, 3).write.mode("append").parquet(view.sources["shops"])
    assert outer.refresh(2) == "full"
    check(spark, outer)


def test_total_without_keys_and_empty_sources(spark, folder):
    sales(spark, 0, 0).write.parquet(f"{folder}/sales")
    view = StoredQueryView(spark, f"{folder}/view", "SELECT count(*) AS n, sum(amount) AS total, approx_count_distinct(buyer) AS b FROM sales",
                           {"sales": f"{folder}/sales"}, min_interval_ms=0)
    assert view.refresh(0) == "full" and rows(view.read()) == ["Row(n=0, total=None, b=0)"]
    sales(spark, 0, 50).write.mode("append").parquet(f"{folder}/sales")
    assert view.refresh(1) == "incremental"
    check(spark, view, "b")


def test_disabled_and_never_refreshed(spark, view):
    view.enable_refresh = False
    with pytest.raises(ValueError):
        view.read()
    assert view.refresh(0) == "disabled" and view.refresh(0, force=True) == "full"


@pytest.mark.parametrize("query", [
    "SELECT kind FROM sales", "SELECT kind, count(*) AS n FROM sales GROUP BY 1", "SELECT kind, count(*) AS n FROM sales GROUP BY kind ORDER BY n",
    "SELECT kind, count(DISTINCT buyer) AS n FROM sales GROUP BY kind", "SELECT count(*) AS n FROM sales GROUP BY kind",
    "SELECT kind, sum(amount) FROM sales GROUP BY kind"])
def test_other_queries_are_refused(spark, query):
    with pytest.raises(ValueError):
        StateQuery.parse(spark, query)


def test_subqueries_are_never_maintained(spark):
    parts = StateQuery.parse(spark, "SELECT kind, count(*) AS n FROM sales WHERE shop IN (SELECT shop FROM shops) GROUP BY kind")
    assert not parts.maintainable(["sales"])
