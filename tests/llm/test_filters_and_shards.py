"""URL filters (9) and sharding (10)."""

from collections import Counter, defaultdict
import random
import zlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.llm import sharding, url_filters
from lakeops.llm.queries import URL_RULES, op10_sharding
from tests.llm.conftest import ROWS

SF = "/root/testdata/sf0.001"


def judged(spark, urls, rules=URL_RULES, **options):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    found = url_filters.filter_urls(spark, pages, rules, **options).collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r["page_id"])]


def test_urls(spark):
    urls = ["http://WWW.example.com/en/1?x#y", "https://example.com/en/", "http://a.b.example.com/en/x", "http://com/", "http://com",
            "http://notexample.net/fr/", "http://x.net/en/", None, "", "no scheme/en/", "http://x.net?q=/fr/", "a://b.net/es/c://d",
            "http://example.com/en/" + "y" * 100_000, "http://.net/es/", "http:///en/"]
    assert judged(spark, urls) == [
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("example.com", "/en/", "example.com/en/", "block"),
        ("a.b.example.com", "/en/x", "example.com/en/", "block"), ("com", "/", "com/", "allow"), ("com", "", None, "allow"),
        ("notexample.net", "/fr/", "net/fr/", "block"), ("x.net", "/en/", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("x.net", "", None, "allow"), ("b.net", "/es/c://d", "net/es/", "block"),
        ("example.com", "/en/" + "y" * 100_000, "example.com/en/", "block"), (".net", "/es/", "net/es/", "block"),
        ("", "/en/", None, "allow")]


def test_urls_ties_defaults_and_empty(spark):
    rules = [("b.com", "/", "block"), ("com", "/abc", "allow"), ("a.b.com", "/x", "allow"), ("a.b.com", "/x", "block")]
    assert judged(spark, ["http://a.b.com/x", "http://b.com/abc", "http://c.com/abc"], rules, default="block") == [
        ("a.b.com", "/x", "a.b.com/x", "block"), ("b.com", "/abc", "com/abc", "allow"), ("c.com", "/abc", "com/abc", "allow")]
    assert judged(spark, ["http://a.b.com/x"], []) == [("a.b.com", "/x", None, "allow")]
    assert judged(spark, []) == []


def test_equal_digests_are_told_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(url_filters.xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    rules = [(h, p, v) for h in ("aa", "bb", "a.bb") for p, v in (("/", "block"), ("/x/", "allow"), ("/xy", "block"))]
    url_filters.write_rules(rules, str(tmp_path / "rules"))
    array = url_filters.RuleArray(str(tmp_path / "rules"))
    won = [array.rule(at) if at >= 0 else None for at in array.judge(["aa", "c.a.bb", "cc", "bb"], ["/x/1", "/xy1", "/", "/"])]
    assert won == [b"aa/x/", b"a.bb/xy", None, b"bb/"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(50, 90))
def test_best_fit_decreasing_picks_the_tightest(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    rooms, expected = [], []
    for size in sizes:
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fitting:
            place = min(fitting)[1]
        else:
            rooms.append(capacity)
            place = len(rooms) - 1
        rooms[place] -= size
        expected.append(place)
    assert sharding.best_fit_decreasing(sizes, capacity) == expected


def test_capacity_tree_grows_beyond_a_leaf():
    rng = random.Random(1)
    sizes = sorted((rng.randint(300, 999) for _ in range(5_000)), reverse=True)
    homes = sharding.best_fit_decreasing(sizes, 1_000)
    load = defaultdict(int)
    for size, home in zip(sizes, homes):
        load[home] += size
    assert max(load.values()) <= 1_000 and len(load) <= 1.1 * sum(sizes) / 1_000 + 400


def check_shards(rows, shards):
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(load) <= set(range(shards))
    return load


def test_shards_of_all_documents(spark):
    rows = op10_sharding(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    load = check_shards(rows, 40)
    assert len(rows) == len(docs) and len(load) == 40
    for r in rows:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "bytes", None)
    homes = defaultdict(set)
    for r in rows:
        homes[docs[r["doc_id"]]].add(r["shard"])
    mean = sum(load.values()) / 40
    largest = max(r["size"] for r in rows)
    assert max(load.values()) - min(load.values()) <= max(largest, mean / 100)
    assert all(len(v) == 1 for t, v in homes.items() if len((t or "").encode()) < mean / 10)


def test_shards_of_odd_rows_and_a_group_larger_than_a_shard(spark, odd, none):
    rows = sharding.shard(odd, 3).collect()
    check_shards(rows, 3)
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    assert sharding.shard(none, 3).count() == 0
    many = spark.createDataFrame([(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(3_000)], "doc_id bigint, text string")
    load = check_shards(sharding.shard(many, 10).collect(), 10)
    assert max(load.values()) < 1.1 * sum(load.values()) / 10


def test_shards_of_equal_documents_and_of_three_sizes_are_level(spark):
    equal = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lpad("id", 50, "0").alias("text"))
    rows = sharding.shard(equal).collect()
    assert set(Counter(r["shard"] for r in rows).values()) == {1_500} and set(check_shards(rows, 40).values()) == {99_000}
    filler = F.expr("repeat('x', element_at(array(10, 100, 30000), cast(id % 3 as int) + 1))")
    mixed = spark.range(4_000).select(F.col("id").alias("doc_id"), F.concat("id", filler).alias("text"))
    load = check_shards(sharding.shard(mixed).collect(), 40)
    assert max(load.values()) - min(load.values()) < 0.03 * sum(load.values()) / 40


@given(st.lists(st.integers(1, 500), min_size=1, max_size=80), st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_levelling_keeps_items_and_brings_shards_nearer(sizes, shards):
    sizes.sort(reverse=True)
    before = [i % shards for i in range(len(sizes))]
    after = sharding.level(sizes, before, shards)

    def spread(homes):
        load = [sum(s for s, h in zip(sizes, homes) if h == n) for n in range(shards)]
        return max(load) - min(load)
    assert len(after) == len(sizes) and set(after) <= set(range(shards)) and spread(after) <= spread(before)
