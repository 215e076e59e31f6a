"""Benchmark decontamination by winnowing.

The words of benchmark items become numbers (a document word that no item has is 0), so equality of
words is exact. Of the k-grams in every run of ``window - k + 1`` successive ones, the smallest
hash is kept, on both sides. A span of ``window`` shared words has the same k-grams on both sides
and so keeps the same one: every shared window has a hit, with certainty. Each hit is extended word
by word to both sides, and counts if ``window`` words or more agree.

The fingerprints of the benchmark are sorted and sent to the executors; documents are read once and
never shuffled. A benchmark larger than ``block_bytes`` is taken in blocks, one pass over the
documents for each, with the words hit so far carried as bits and written down between passes, so
memory is bounded by one block and results do not depend on the size.

Items with fewer words than a window are one window and are compared whole. Items without words are
ignored. Null texts have no words. Items that repeat an item_id count once; a null item_id reads as
an empty text. Repeated document rows each come back.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import column, map_batches, slices, texts_as_bytes
from lakeops.session import materialise

WINDOW = 10
GRAM = 5
#: Text of the benchmark that is held in memory at once.
BLOCK_BYTES = 32 << 20
OUTPUT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
_KEPT = set((string.ascii_letters + string.digits).encode()) | set(range(0x80, 0x100))
_TABLE = bytes(c if c in _KEPT else 0x20 for c in range(256)).lower()
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters outside ASCII; A-Z lower-cased."""
    return text.translate(_TABLE).split()


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return value ^ (value >> np.uint64(29))


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` word numbers; the largest value where one of them is below 1."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(size):
        part = ids[i:i + n]
        total = total * np.uint64(0x100000001B3) + part.astype(np.uint64)
        known &= part > 0
    return np.where(known, _mixed(total) >> np.uint64(1), _NEVER)


def winnowed(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places whose hash is the smallest of some ``run`` successive ones."""
    if len(hashes) < run:
        return np.empty(0, np.int64)
    smallest = np.lib.stride_tricks.sliding_window_view(hashes, run).min(1)
    edge = np.zeros(run - 1, np.uint64)
    largest = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, smallest, edge]), run).max(1)
    return np.flatnonzero((largest == hashes) & (hashes != _NEVER))


@dataclass
class Block:
    """A part of the benchmark: word numbers of all items, parted by -1, and sorted fingerprints."""

    vocabulary: dict[bytes, int]
    names: list[str]
    ids: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    window: int
    gram: int

    @classmethod
    def build(cls, items: list[tuple[str, bytes]], window: int = WINDOW, gram: int = GRAM) -> Block:
        vocabulary: dict[bytes, int] = {}
        margin = [-1] * window
        ids, owner, names, starts = list(margin), [-1] * window, [], {}
        for name, text in items:
            numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            if not numbers:
                continue
            if len(numbers) < window:
                starts.setdefault(len(numbers), []).append(len(ids))
            ids += numbers + margin
            owner += [len(names)] * len(numbers) + [-1] * window
            names.append(name)
        array, owners = np.array(ids, np.int64), np.array(owner, np.int64)
        hashes = gram_hashes(array, gram)
        whole = winnowed(hashes, window - gram + 1)
        short = {}
        for length, at in starts.items():
            own = gram_hashes(array, length)[np.array(at)]
            order = np.argsort(own, kind="stable")
            short[length] = (own[order], np.array(at)[order])
        order = np.argsort(hashes[whole], kind="stable")
        return cls(vocabulary, names, array, owners, hashes[whole][order], whole[order], short, window, gram)

    def pairs(self, hashes: np.ndarray, places: np.ndarray, index: np.ndarray, own: np.ndarray):
        """Places in the documents with places in the items of equal hash, in bounded portions."""
        low = np.searchsorted(index, hashes)
        count = np.searchsorted(index, hashes, "right") - low
        hit = np.flatnonzero(count)
        start = 0
        while start < len(hit):
            stop = start + max(1, int(np.searchsorted(np.cumsum(count[hit[start:]]), 1 << 18)))
            part = hit[start:stop]
            within = np.arange(count[part].sum()) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
            yield np.repeat(places[part], count[part]), own[np.repeat(low[part], count[part]) + within]
            start = stop

    def marks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words (numbers with ``window`` zeros around each document) are hit; (place, item) of hits."""
        change = np.zeros(len(ids) + 1, np.int64)
        found = []

        def hit(first: np.ndarray, last: np.ndarray, places: np.ndarray) -> None:
            np.add.at(change, first, 1)
            np.add.at(change, last, -1)
            found.append(np.unique(np.stack([first, self.owner[places]], 1), axis=0))

        hashes = gram_hashes(ids, self.gram)
        kept = winnowed(hashes, self.window - self.gram + 1)
        reach = self.window - self.gram
        for p, q in self.pairs(hashes[kept], kept, self.hashes, self.places):
            equal = [self.ids[q + i] == ids[p + i] for i in range(-reach, self.gram + reach)]
            left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            on = np.logical_and.reduce(equal[reach:reach + self.gram])
            for side, steps in ((left, range(reach - 1, -1, -1)), (right, range(reach + self.gram, len(equal)))):
                going = on.copy()
                for i in steps:
                    going &= equal[i]
                    side += going
            good = on & (left + self.gram + right >= self.window)
            hit((p - left)[good], (p + self.gram + right)[good], q[good])
        for length, (index, places) in self.short.items():
            own = gram_hashes(ids, length)
            at = np.flatnonzero(own != _NEVER)
            for p, q in self.pairs(own[at], at, index, places):
                good = np.logical_and.reduce([self.ids[q + i] == ids[p + i] for i in range(length)])
                hit(p[good], p[good] + length, q[good])
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return np.cumsum(change[:-1]) > 0, pairs


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """The items, dealt into blocks by a hash; each is collected alone and holds about ``block_bytes``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    if count > 1:
        items = materialise(items, "benchmark")

    def collected():
        for block in range(count):
            part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block) if count > 1 else items
            yield [(row["item"], row["text"].encode()) for row in part.collect()]

    return count, collected()


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW,
                  gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    ``keep`` names other columns of ``docs`` to pass on, ``text`` among them if wanted.
    """
    spark = docs.sparkSession
    passed = [c for c in keep or [] if c not in ("doc_id", *OUTPUT)]
    state = docs.select("doc_id", *passed, *([] if "text" in passed else ["text"]),
                        F.lit(None).cast("binary").alias("_hits"), F.array().cast("array<string>").alias("_items"))
    count, blocks = _blocks(benchmark, block_bytes)
    extra = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    final = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}{extra}, n_words bigint, n_hit bigint, "
             "n_items bigint, items_sha256 string, contaminated boolean")
    for number, items in enumerate(blocks):
        block = spark.sparkContext.broadcast(Block.build(items, window, gram))
        last, names = number == count - 1, state.columns

        def mark(batches, block=block, names=names, last=last):
            for batch in batches:
                for part in slices(batch):
                    marked, n_words = _mark(part, block.value, names)
                    yield _conclude(marked, n_words, passed) if last else marked

        state = map_batches(state, final if last else state.schema, mark)
        if not last:
            state = materialise(state, "hits")
    return state


def _mark(part: pa.RecordBatch, block: Block, names: list[str]) -> tuple[pa.RecordBatch, list[int]]:
    number, margin = block.vocabulary.get, [0] * block.window
    ids, starts, lengths = list(margin), [], []
    for text in texts_as_bytes(part):
        words = words_of(text)
        starts.append(len(ids))
        lengths.append(len(words))
        ids += [number(w, 0) for w in words]
        ids += margin
    hit, pairs = block.marks(np.array(ids, np.int64))
    owners = np.searchsorted(np.array(starts), pairs[:, 0], "right") - 1
    items: list[set[str]] = [set(x) for x in column(part, "_items").to_pylist()]
    for doc, item in set(zip(owners.tolist(), pairs[:, 1].tolist())):
        items[doc].add(block.names[item])
    bits = []
    for start, length, before in zip(starts, lengths, column(part, "_hits").to_pylist()):
        own = np.packbits(hit[start:start + length])
        bits.append((own if before is None else own | np.frombuffer(before, np.uint8)).tobytes())
    made = {"_hits": pa.array(bits, pa.binary()), "_items": pa.array([sorted(x) for x in items], pa.list_(pa.string()))}
    columns = [made[n] if n in made else column(part, n) for n in names]
    return pa.RecordBatch.from_arrays(columns, names=names), lengths


def _conclude(part: pa.RecordBatch, n_words: list[int], passed: list[str]) -> pa.RecordBatch:
    n_hit = [int(np.unpackbits(np.frombuffer(b, np.uint8)).sum()) for b in column(part, "_hits").to_pylist()]
    items = column(part, "_items").to_pylist()
    made = {
        "n_words": pa.array(n_words, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(x) for x in items], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
        "contaminated": pa.array([n > 0 for n in n_hit])}
    names = ["doc_id", *passed, *made]
    return pa.RecordBatch.from_arrays([made[n] if n in made else column(part, n) for n in names], names=names)
