"""Quality rules (1), language ID (4) and the quality classifier (7)."""

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lakeops.llm import language, quality_classifier, quality_rules
from lakeops.llm.common import id_bucket
from lakeops.llm.queries import op1_quality_rules, op4_language_id, op7_quality_classifier
from tests.llm.conftest import BODY, ROWS, frame

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_rules_on_all_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in op1_quality_rules(spark, SF).collect()}
    assert found.keys() == docs.keys()
    for doc_id, text in docs.items():
        assert tuple(found[doc_id][c] for c in COUNTS) == plain_counts(text)
        assert not (found[doc_id]["base_failed"] and found[doc_id]["kept"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [found[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1 and not found[r["doc_id"]]["base_failed"]]
    bad = [found[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


def test_rules_plan_has_no_python(spark):
    plan = op1_quality_rules(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_counts_of_odd_rows(spark, odd, none):
    more = [(20, "a b c " * 40 + " ".join(f"u{i}" for i in range(20)), "en"), (21, " ".join(f"p{i // 2} q{i % 40}" for i in range(900)), "en"),
            (22, "x y\nx y\n\n \nz", "en"), (23, "same same same same", None)]
    rows = quality_rules.text_statistics(odd.union(frame(spark, more))).withColumn("base_failed", quality_rules.base_failed()).collect()
    assert Counter(tuple(r[c] for c in COUNTS) for r in rows) == Counter(plain_counts(r[1]) for r in ROWS + more)
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 0)], "doc_id bigint, quality int")
    assert quality_rules.apply_rules(odd, labels).count() == len(ROWS)
    assert quality_rules.apply_rules(none, labels).count() == 0
    kept = quality_rules.apply_rules(frame(spark, [(1, BODY + " one two three " + BODY.upper() + " " + " ".join("abcdefghijklmn"), "en")]),
                                     labels.where("false")).first()
    assert kept["n_words"] >= 50 and kept["kept"]


def test_rules_find_a_planted_threshold(spark):
    rows = spark.range(600).select(
        F.col("id").alias("doc_id"), F.lit(100).cast("bigint").alias("n_words"), F.lit(500).cast("bigint").alias("word_chars"),
        F.when(F.col("id") % 5 == 0, 50 + F.col("id") % 7).otherwise(F.col("id") % 9).alias("n_symbols"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("n_dup_lines", "n_repeat_words", "n_capitals", "n_bangs")],
        F.lit(3).cast("bigint").alias("n_lines"), (F.col("id") % 5 != 0).cast("int").alias("quality"))
    rules = quality_rules.learn_rules(rows)
    assert len(rules) == 1 and [(c.statistic, c.above) for c in rules[0]] == [("symbol_share", True)]
    assert 8 / 500 < rules[0][0].threshold < 50 / 500


def test_labelled_texts_without_words(spark):
    # ratios have no value in every seventh text, and the others are told apart by one of them
    words = "array_join(transform(sequence(1, 60), i -> concat({}, id, 'w', i)), ' ')".format
    docs = spark.range(280).selectExpr("id AS doc_id", "CASE id % 7 WHEN 0 THEN substring(' \t\n', 1, CAST(id % 4 AS int)) WHEN 1 THEN NULL "
                                       f"ELSE if(id % 2 = 0, {words("'#$'")}, {words("'ab'")}) END AS text")
    labels = spark.range(280).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    found = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, labels).collect()}
    assert len(found) == 280 and all(found[i]["base_failed"] and not found[i]["kept"] for i in range(280) if i % 7 < 2)
    assert all(found[i]["kept"] == (i % 2 == 1) for i in range(280) if i % 7 > 1)


def test_languages_of_held_out_documents(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = op4_language_id(spark, SF).collect()
    assert {r["doc_id"] for r in found} == docs.keys() and len(found) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"] and docs[r["doc_id"]]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) > 0.97 * len(held)


def test_languages_never_see_what_is_held_out(spark):
    rows = [(i, "abc def " * 5, "xx") for i in range(40)]
    changed = [(i, t, "yy" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    for some in (rows, changed):
        assert {r["lang_pred"] for r in language.identify(frame(spark, some), held_out).collect()} == {"xx"}


def test_languages_of_odd_rows(spark, odd, none):
    model = language.fit(odd)
    found = language.predict(odd, model, keep=odd.columns)
    assert set(odd.columns) <= set(found.columns) and model.languages == ["de", "en", "fr"]
    rows = found.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) == (r["text"] is None or not any(map(str.isalpha, r["text"]))) for r in rows)
    nothing = language.fit(none)
    assert {(r["lang_pred"], r["score"]) for r in language.predict(odd, nothing).collect()} == {("und", 0.0)}
    assert language.predict(none, model).count() == 0


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = op7_quality_classifier(spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)
               and 0 <= r["score"] <= 1 for r in found)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in quality]
    good, bad = [p for q, p in held if q == 1], [p for q, p in held if q == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.1 * len(bad)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (9, None), (77, 1)], "doc_id bigint, quality int")
    everything = F.lit(True)
    weights = quality_classifier.fit(odd, labels, everything)
    rows = quality_classifier.score(odd, weights).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1
    for docs, marks in ((none, labels), (odd, labels.where("false"))):
        assert not quality_classifier.fit(docs, marks, everything).any()
    assert {r["score"] for r in quality_classifier.score(odd, quality_classifier.fit(none, labels, everything)).collect()} == {0.5}
