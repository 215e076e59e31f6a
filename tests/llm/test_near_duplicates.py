"""SimHash near-dedup (6), its pipeline stage, and connected components."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from lakeops.llm import simhash
from lakeops.llm.components import connected_components
from lakeops.llm.queries import op6_simhash
from tests.llm.conftest import BODY, ROWS, frame

SF = "/root/testdata/sf0.001"


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: plain_print(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    linked = [(a, b) for a, b in combinations(docs, 2) if (docs[a] ^ docs[b]).bit_count() <= 2]
    expected = roots(docs, linked)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op6_simhash(spark, SF).collect()}
    assert found == {d: (format(p, "016x"), expected[d]) for d, p in docs.items()}


def test_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert by[1] == by[2] and by[11] == by[1] and {c for _, c in by[1]} == {1}
    assert {c for _, c in by[None]} == {None}
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks, rng = simhash.covering_masks(radius), random.Random(radius)
    for _ in range(2_000):
        flips = sum(1 << i for i in rng.sample(range(64), radius))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("radius", [2, 3])
def test_links_connect_what_brute_force_connects(spark, radius):
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        value = rng.getrandbits(64)
        for _ in range(12):
            prints.add(value)
            value ^= sum(1 << i for i in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
    hot = rng.getrandbits(64)
    prints |= {hot ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}
    signed = {simhash._signed(p): p for p in prints}
    expected = roots(signed, [(a, b) for a, b in combinations(signed, 2) if (signed[a] ^ signed[b]).bit_count() <= radius])
    edges = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp bigint"), radius).collect()
    assert all((signed[e["fp"]] ^ signed[e["hub"]]).bit_count() <= 2 * radius for e in edges)
    assert roots(signed, [(e["fp"], e["hub"]) for e in edges]) == expected


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1_000, 1_200)] + [(5, 5), (3, None), (2, 1), (2, 1), (4, 2)]
    found = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(1_000, 1_200)}, 5: 5, 1: 1, 2: 1, 4: 1}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_stage_keeps_one_of_each_group_and_all_others(spark, odd, none):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5_000)]
    rows, n = [], 0
    for group in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([60, 200, 600]))]
        for copy in range(4):
            own = list(words)
            for place in range(0, len(own) if copy else 0, 150):
                own[place + rng.randrange(min(50, len(own) - place))] = "changed"
            rows.append((group * 10 + copy, " ".join(own), "en"))
    clean = [(1_000 + i, " ".join(rng.choice(vocabulary) for _ in range(150)), "en") for i in range(40)]
    half = [(2_000 + i, " ".join(rows[8][1].split()[:30] + [rng.choice(vocabulary) for _ in range(200)]), "en") for i in range(5)]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(frame(spark, rows + clean + half)).collect()}
    assert kept == {group * 10 for group in range(12)} | {r[0] for r in clean + half}
    ids = [r["doc_id"] for r in simhash.drop_near_duplicates(odd).collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 9, 10, 12, 13] and ids.count(None) == 2
    assert simhash.drop_near_duplicates(none).count() == 0


def test_fingerprint_counts_blocks():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    sums = [2 * int(((hashes >> np.uint64(i)) & np.uint64(1)).sum()) > len(hashes) for i in range(64)]
    assert simhash.fingerprint(hashes) == sum(1 << i for i, on in enumerate(sums) if on)
    assert plain_print(BODY) == simhash.fingerprint(simhash.shingle_hashes(BODY.encode().split(), 3))


def jaccard_groups(rows, size=5, similarity=0.8):
    sets = {}
    for doc, text, *_ in rows:
        words = text.lower().split()
        sets[doc] = {" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} or {" ".join(words)}
    linked = [(a, b) for a, b in combinations(sets, 2)
              if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    return roots(sets, linked)


def test_stage_equals_brute_force_at_short_lengths(spark):
    """Pairs of 50 to 300 words near the threshold, most without an equal passage."""
    rng, rows = random.Random(11), []
    for n in (50, 60, 80, 100, 150, 200, 300):
        for _ in range(25):
            words = [f"w{rng.randrange(100_000)}" for _ in range(n)]
            rows.append((len(rows), " ".join(words), "en"))
            for place in rng.sample(range(n), max(1, n * rng.randrange(1, 6) // 100)):
                words[place] = "changed"
            rows.append((len(rows), " ".join(words), "en"))
    expected = jaccard_groups(rows)
    assert 60 < sum(d != c for d, c in expected.items()) < 175
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(frame(spark, rows)).collect()}
    assert kept == set(expected.values())


def test_stage_goes_on_where_the_hub_of_a_bucket_fails(spark):
    """One hot text with edits near each other: of its copies only some are similar, in chains that miss the hub."""
    rng = random.Random(4)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(160):
        words = list(base)
        for place in rng.sample(range(10, 90), rng.choice([2, 2, 3, 3, 4])):
            words[place] = f"own{i}"
        rows.append((i, " ".join(words), "en"))
    for i in range(0, 160, 4):  # a chain: similar to its start, and little like the other copies
        words = rows[i][1].split()
        words[rng.randrange(10)] = f"more{i}"
        rows.append((1_000 + i, " ".join(words), "en"))
    expected = jaccard_groups(rows)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(frame(spark, rows)).collect()}
    assert kept == set(expected.values())
