"""Ranked search (11), substring dedup (12) and the Merkle manifest (13)."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.llm import lexical_search, merkle, substring_dedup
from tests.llm.conftest import LONG, ROWS, frame

LAST = 1 << 70
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ranked_plainly(docs, items, best=10):
    found = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    found = [x for x in found if x[1]]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(TERM.findall((text or "").translate(LOWER)))
    rows = []
    for item, query in asked.items():
        scores = []
        for d, counts in found:
            m = 25 + 75 * sum(counts.values()) * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * counts[t] // (1000 * counts[t] + 8 * m)) for t, times in query.items() if t in counts)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        rows += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores, key=lambda s: s[:3])[:best])]
    return Counter(rows)


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_search_of_random_rows(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(lexical_search, "FIRST", 20)
    rng = random.Random(3)
    words = ["alpha", "Beta", "ü1", "x2", "zz"] + [f"w{i}" for i in range(40)]
    docs = [(rng.choice([None, rng.randrange(80)]),
             rng.choice([None, ""] + [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(8)])) for _ in range(500)]
    items = [(rng.choice([None, rng.randrange(9)]),
              rng.choice([None, "", "!!!", " ".join(rng.choices(words, k=4)), " ".join(rng.choices(words, k=40))])) for _ in range(20)]
    items += items[:3]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    result = lexical_search.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6), asked, block_bytes=block_bytes)
    assert Counter(tuple(r) for r in result.collect()) == ranked_plainly(docs, items)


def test_search_of_odd_rows(spark, odd, none):
    items = [(1, "the quick brown fox"), (2, "word1 stone3 ÄÖÜ"), (3, None), (4, "nowhere")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    expected = ranked_plainly([r[:2] for r in ROWS], items)
    assert Counter(tuple(r) for r in lexical_search.search(odd, asked).collect()) == expected
    assert lexical_search.search(none, asked).count() == 0
    assert lexical_search.search(odd, asked.limit(0)).count() == 0


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_bounds_keep_every_document_at_the_threshold(data):
    size = 12
    weights = np.array(data.draw(st.lists(st.integers(0, 9000), min_size=size, max_size=size)), np.int64)
    draw = st.dictionaries(st.integers(0, size - 1), st.integers(1, 999_999), min_size=1)
    docs = data.draw(st.lists(draw, min_size=1, max_size=8))
    asked = Counter(data.draw(st.dictionaries(st.sampled_from([bytes([65 + i]) for i in range(size)]), st.integers(1, 4), min_size=1)))
    number = {bytes([65 + i]): i for i in range(size)}
    roots = np.sqrt(weights.astype(float))
    query = lexical_search.Query.build(asked, number, weights)
    terms = [np.array(sorted(d), np.uint32) for d in docs]
    values = [np.array([d[t] for t in sorted(d)], np.uint32) for d in docs]
    lengths = np.array([np.linalg.norm(v * roots[t]) for t, v in zip(terms, values)])
    bucket = lexical_search.Bucket(lengths, terms, values, roots)
    exact = np.array([sum(int(weights[number[t]]) * n * d.get(number[t], 0) for t, n in asked.items()) for d in docs])
    dense = np.zeros(size, np.int64)
    assert bucket.scores(np.arange(len(docs)), query, dense).tolist() == exact.tolist() and not dense.any()
    for threshold in {max(1, int(x)) for x in exact}:
        assert set(np.flatnonzero(exact >= threshold)) <= set(bucket.candidates(query, threshold).tolist())


def cut_plainly(rows, size):
    docs = [(LAST if d is None else d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    first = {}
    for d, words in sorted(docs, key=lambda x: x[0]):
        for p in range(len(words) - size + 1):
            first.setdefault(tuple(words[p:p + size]), d)
    found = []
    for d, words in docs:
        gone, seen = [False] * len(words), set()
        for p in range(len(words) - size + 1):
            window = tuple(words[p:p + size])
            if first[window] < d or window in seen:
                gone[p:p + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        found.append((d, len(words), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


def cut(df, size):
    rows = substring_dedup.remove_repeated_windows(df, size, with_text=True).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)
    return Counter((LAST if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


def test_windows_of_odd_rows(spark, odd, none):
    for size in (1, 5, 20):
        assert cut(odd, size) == cut_plainly([r[:2] for r in ROWS], size)
    assert cut(none, 20) == Counter()
    with pytest.raises(TypeError):
        substring_dedup.remove_repeated_windows(odd.withColumn("doc_id", F.lit("a")))


@pytest.mark.parametrize("size", [1, 2, 4, 20])
def test_windows_of_shared_passages(spark, size):
    """Overlapping, periodic and shared passages, equal and null ids, and copies, over several tasks."""
    rng = random.Random(size)
    passages = [" ".join(rng.choice("abc") for _ in range(rng.choice([3, 4, 5, 9, 30, 45]))) for _ in range(8)]
    rows = []
    for i in range(300):
        text = "  ".join(rng.choice([*passages, f"u{i}", f"v{rng.randrange(9)}\n"]) for _ in range(rng.randrange(8)))
        rows.append((rng.choice([None, rng.randrange(60), i]), rng.choice([text, text, text, None, "", passages[0]])))
    assert cut(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), size) == cut_plainly(rows, size)


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 6))
@settings(max_examples=50, deadline=None)
def test_rolling_hashes_tell_windows_apart(values, size):
    own = np.array([xxhash.xxh64_intdigest(bytes([v])) for v in range(4)], np.uint64)[np.array(values, np.int64)] if values else np.empty(0, np.uint64)
    hashes = substring_dedup.Rolling(substring_dedup._BASES[0], size)(own).tolist()
    windows = [tuple(values[i:i + size]) for i in range(len(values) - size + 1)]
    assert len(hashes) == len(windows)
    assert len(set(zip(hashes, windows))) == len(set(hashes)) == len(set(windows))


def test_long_texts_are_split_at_spaces():
    text = LONG.encode()
    assert [w for part in substring_dedup.pieces(text, 1000) for w in part] == text.split()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_plainly(rows):
    """Rows are doc_id, text, lang, source, n_chars."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha(*map(field, (r[0], r[3], r[2], r[4], text)))

    def tower(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r, r[1])))
        trees[s] = tower([leaf(r, r[1]) for r in by[s]])
    top = tower([trees[s][-1][0] for s in order])
    found = []
    for number, s in enumerate(order):
        for i, r in enumerate(by[s]):
            own = current = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                current = leaf(r, r[1] and r[1].translate(LOWER))
            siblings = []
            for levels, place in ((trees[s], i), (top, number)):
                for level in levels[:-1]:
                    run, at = level[place // 16 * 16:place // 16 * 16 + 16], place % 16
                    siblings += run[:at] + run[at + 1:]
                    current = sha(*run[:at], current, *run[at + 1:])
                    place //= 16
            found.append((r[0], own, trees[s][-1][0], top[-1][0], sha(*siblings), current, current == top[-1][0]))
    return Counter(found)


DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_manifest_of_many_sources_and_a_deep_one(spark):
    """A source beyond one block, runs of one at several levels, more than sixteen sources, ties and nulls."""
    rng = random.Random(1)
    rows = [(i, f"Text {i} Ü", "en", "deep", i) for i in range(merkle.BLOCK + 17)]
    rows += [(rng.choice([None, i, 7]), rng.choice([None, "", "Same Text"]), rng.choice([None, "de"]),
              rng.choice([None, "", "é"] + [f"s{j}" for j in range(300)]), rng.choice([None, i])) for i in range(1_000)]
    rows += rows[-40:]
    df = spark.createDataFrame(rows, DOCUMENT).repartition(5)
    assert Counter(tuple(r) for r in merkle.manifest(df).collect()) == manifest_plainly(rows)


def test_manifest_of_odd_rows(spark, odd, none):
    rows = [(*r, None, None) for r in ROWS]
    assert Counter(tuple(r) for r in merkle.manifest(odd).collect()) == manifest_plainly(rows)
    result = merkle.manifest(none)
    assert result.count() == 0 and result.columns[-1] == "verified"
    lone = frame(spark, [(5, "Alone")])
    assert Counter(tuple(r) for r in merkle.manifest(lone).collect()) == manifest_plainly([(5, "Alone", None, None, None)])


def test_manifest_detects_any_change(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)], DOCUMENT)
    changed = merkle.leaf_of(n_chars=F.when(F.col("doc_id") == 42, F.lit(0)).otherwise(F.col("n_chars")))
    found = merkle.build(docs, changed).proofs().where("not verified").collect()
    assert [r["doc_id"] for r in found] == [42]


@given(st.integers(1, 300))
@settings(max_examples=25, deadline=None)
def test_every_path_folds_to_the_root(size):
    digests = [sha(str(i)).encode() for i in range(size)]
    root, runs = merkle.forward(digests, merkle.depth(size))
    paths = merkle.backward(size, runs, [])
    assert all(merkle.fold(d, merkle._unpacked(merkle._packed(p))) == root for d, p in zip(digests, paths))
