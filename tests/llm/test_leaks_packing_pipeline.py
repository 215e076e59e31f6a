"""Benchmark decontamination (8), best-fit packing (5) and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from lakeops.llm import decontaminate, packing
from lakeops.llm.queries import op5_best_fit_packing
from tests.llm.conftest import BODY, ROWS, frame

SF = "/root/testdata/sf0.001"
TOKENS = public_tokenizers.path("word_bpe_49k.json")


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i:i + 10])].add(item)
    sizes = {len(w) for w in windows}
    found = []
    for doc_id, text in docs:
        words, hit, owners = plain_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    owners |= windows[tuple(words[i:i + size])]
        digest = hashlib.sha256(",".join(sorted(owners)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(owners), digest, bool(hit)))
    return Counter(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_leaks_equal_brute_force_in_one_block_and_in_many(spark, odd, none, block_bytes):
    rng = random.Random(2)
    vocabulary = ["aa", "bb", "cc", "Dd", "é", "7x"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 30]))) for _ in range(30)]
    items = [(str(i), t) for i, t in enumerate(texts)] + [("5", texts[7]), ("99", BODY), ("100", None)]
    rows = [(i, ", ".join(rng.choice(texts) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(6)), "en") for i in range(60)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    result = decontaminate.decontaminate(odd.union(frame(spark, rows)), bench, block_bytes=block_bytes)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(tuple(r[n] for n in names) for r in result.collect()) == plain_hits([r[:2] for r in ROWS + rows], items)
    assert decontaminate.decontaminate(none, bench, block_bytes=block_bytes).count() == 0
    clean = decontaminate.decontaminate(odd, bench.where("false"), keep=odd.columns, block_bytes=block_bytes)
    assert set(odd.columns) <= set(clean.columns) and clean.where("contaminated").count() == 0


def test_packing_of_all_documents(spark):
    rows = op5_best_fit_packing(spark, SF).collect()
    whole = Tokenizer.from_file(TOKENS)
    ids = {r["doc_id"]: np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
           for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_pieces(rows, ids)
    total = sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 1


def check_pieces(rows, ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for doc_id, own in pieces.items():
        at = 0
        for n, r in enumerate(sorted(own, key=lambda r: r["piece"])):
            part = ids[doc_id][at:at + 4096]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (n, at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
        assert at == len(ids[doc_id])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_of_odd_rows(spark, odd, none):
    rows = packing.pack_documents(odd, TOKENS).collect()
    whole = Tokenizer.from_file(TOKENS)
    lengths = Counter()
    for _, text, *_ in ROWS:
        n = len(whole.encode(text or "", add_special_tokens=False).ids) + 1
        lengths += Counter([4096] * (n // 4096) + ([n % 4096] if n % 4096 else []))
    assert Counter(r["length"] for r in rows) == lengths
    assert packing.pack_documents(none, TOKENS).count() == 0


def test_word_ids_equal_whole_texts():
    whole, words = Tokenizer.from_file(TOKENS), packing.WordIds(TOKENS)
    texts = ["", " \n a", "<|endoftext|> x<|startoftext|>y", "é ́a A B C\x1c d\x85e", "don't 'S we'LL 12345 ½ ΣΑΣ",
             "中文 字\t\r\nx\x00y", "ÀÉÎÕÜ ß ÿ × ÷ µ ª º ² Œ İ ſ a_b x-1.5%|} ~^`", "<|a|> 3.14 [1,2] https://a.b/c?d=1&e#f"]
    texts += [f"{chr(c)}a{chr(c)}{chr(c)}1" for c in range(1, 0x300)]
    for text in texts:
        assert words.of_text(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def fewest(sizes, capacity):
    """The least number of bins, by trying everything."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0] and i < len(sizes):
            return
        if i == len(sizes):
            best[0] = min(best[0], len(rooms))
            return
        for room in sorted({r for r in rooms if r >= sizes[i]}):
            at = rooms.index(room)
            place(i + 1, [*rooms[:at], room - sizes[i], *rooms[at + 1:]])
        place(i + 1, [*rooms, capacity - sizes[i]])
    place(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_bin_completion_is_optimal_on_small_inputs(sizes):
    counts = np.bincount(sizes, minlength=31)
    patterns = packing.bin_completion(counts, 30)
    used = Counter()
    for shape, times in patterns:
        assert sum(x * n for x, n in shape) <= 30
        for x, n in shape:
            used[x] += n * times
    assert used == Counter(sizes)
    number = sum(times for _, times in patterns)
    assert number == fewest(sorted(sizes, reverse=True), 30) >= packing.least_sequences(counts, 30)


def test_bin_completion_beats_best_fit_and_counts_stay_small():
    sizes = [6, 5, 5, 5, 4, 3, 2] * 1_000_000  # best-fit-decreasing wastes room here
    counts = np.zeros(16, np.int64)
    for size in sizes[:7]:
        counts[size] += 1_000_000
    patterns = packing.bin_completion(counts, 15)
    assert sum(times for _, times in patterns) == -(-30 * 1_000_000 // 15) and len(patterns) < 20


def test_pipeline_stages_on_planted_documents(spark):
    rng = random.Random(4)
    vocabulary = {"en": [f"th{x}ing" for x in "abcdefghijklmnopqrstuvwxyz"] + [f"{x}{y}wh" for x in "aeiou" for y in "bcdlmnrst"],
                  "de": [f"sch{x}en" for x in "abcdefghijklmnopqrstuvwxyz"] + [f"{x}{y}ü" for x in "aeiou" for y in "bcdlmnrst"]}

    def prose(lang, n):
        return " ".join(rng.choice(vocabulary[lang]) for _ in range(n))

    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = [(i, "\n".join(prose(lang, 30) for _ in range(4)), lang, "s", 1) for i, lang in enumerate(["en", "de"] * 20)]
    junk = [(100, "123 456 !!!", "en", "s", 1), (101, None, None, None, None), (102, "", "en", "s", 0)]
    copies = [(200, clean[3][1], "de", "s", 1), (201, clean[3][1].replace("schaen", "schban", 1), "de", "s", 1)]
    leaks = [(300, prose("en", 40) + " " + bench.replace("\n", " ") + " " + prose("en", 40), "en", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(clean + junk + copies + leaks, schema)
    stages = dict(corpus_pipeline.STAGES)
    every = {r[0] for r in clean + copies + leaks}

    def kept(name):
        frame = stages[name](spark, docs, SF)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        return {r["doc_id"] for r in frame.collect()}

    assert kept("language_id") == every
    lines = {r["doc_id"]: r for r in stages["line_dedup"](spark, docs, SF).collect()}
    assert {i for i in lines if i < 100} == {r[0] for r in clean} and 200 not in lines and 300 in lines
    assert all(lines[r[0]]["text"] == r[1] for r in clean)
    assert kept("simhash_near_dedup") == {r[0] for r in clean} | {100, 101, 300}
    assert kept("benchmark_decontamination") == every - {300} | {100, 101, 102}


def test_pipeline_runs_from_end_to_end(spark):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    rows = corpus_pipeline.run(spark, SF).collect()
    load = Counter()
    for r in rows:
        load[r["sequence_id"]] += r["length"]
    assert max(load.values()) <= 4096 and len(load) <= -(-sum(load.values()) // 4096) + 1
    assert len({r["doc_id"] for r in rows}) > 100


def test_pieces_keep_their_own_places():
    shapes = [(((5, 2), (3, 1)), 4), (((5, 1), (2, 3)), 3)]
    places = packing.Places(shapes)
    taken = defaultdict(set)
    for length, number in ((5, 11), (3, 4), (2, 9)):
        sequence, offset = places.find(np.full(number, length, np.int64), np.arange(number, dtype=np.int64))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            own = set(range(o, o + length))
            assert not taken[s] & own
            taken[s] |= own
    assert sorted(map(len, taken.values())) == [11] * 3 + [13] * 4
    assert all(taken[s] == set(range(len(taken[s]))) for s in taken)


def test_words_met_again_outlive_a_full_memory(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "_KNOWN_LIMIT", 8)
    known, asked = packing.WordIds(path), []
    merge = known.merge
    known.merge = lambda run: asked.append(run) or merge(run)
    words = [f"{w}{'abcdefghij'[i % 10]}" for i, w in enumerate(["stone", "Water,", "straße", "don't", "x9", "<|y|>", "中"] * 10)]
    text = " ".join(w for word in words for w in ("common", word))
    plain = packing.WordIds(path)
    assert known.of_text(text) == b"".join(
        np.array(plain.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in text.split(" "))
    assert asked.count("common") == 1 and len(known) <= 8 and len(known.runs) <= 8
