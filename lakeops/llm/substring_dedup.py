"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

Every word goes that is covered by a window of ``size`` consecutive words whose word sequence also starts
earlier: in a document with a smaller doc_id, or earlier in the same one. Words are runs of bytes other than
space and ``\\t\\n\\v\\f\\r``; windows are judged on the input and never cross documents.

1. *Windows.* Words have 128-bit hashes. Two rolling polynomial hashes, modulo 2 ** 64 and with different bases,
   give every window 64 bits and a bucket with 8 more. Inside a slice of texts, windows that have an earlier
   equal one there are known to go: neighbours merge into intervals at once, and only the earliest holder of a
   window is sent on. A passage that a third of all documents share is sent once for each slice, and a
   document that repeats in a slice costs no window.
2. *Counts.* A task holds one bucket, whose number grows with the corpus, and finds the windows that holders
   with different doc_ids sent. All but the smallest doc_id get the window's hash back, packed by groups of texts.
3. *Intervals.* Texts meet their hashes and intervals. Windows that go are merged into maximal intervals of words,
   and the remaining words are joined by one space.

Windows are told apart by 72 bits and the bucket's number (22 bits more for ten million buckets); within one text by
64. doc_id must be an integer column. A null doc_id is larger than all others. Rows with the same doc_id do not
shorten each other: texts of one doc_id are judged apart, repeated rows come back alike. Null, empty and short
texts lose nothing. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import column, map_batches, pieces, settle, slices, texts_as_bytes

SIZE = 20
#: Text whose windows one task gathers at most, about.
TASK_BYTES = 12 << 20
_SLICE = 4 << 20
_LAST_ID = (1 << 63) - 1
#: Words that are split, and windows that are hashed, at once.
_CHUNK = 1 << 20
_MEMO = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Words(dict):
    """Numbers of words, as they are met, and their hashes in two tables."""

    def __init__(self) -> None:
        self.tables = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        value = xxhash.xxh3_128_intdigest(word)
        self.tables[0].append(value >> 64)
        self.tables[1].append(value & 0xFFFFFFFFFFFFFFFF)
        return number

    def hashes(self, numbers: np.ndarray, table: int) -> np.ndarray:
        return np.array(self.tables[table], np.uint64)[numbers]


def numbers_of(text: bytes, words: Words) -> np.ndarray:
    known = words.__getitem__
    parts = [np.fromiter(map(known, found), np.int64, len(found)) for found in pieces(text)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


class Rolling:
    """Polynomial hash of each run of ``size`` values: a sum over a prefix less a shorter one, shifted into place."""

    def __init__(self, base: int, size: int) -> None:
        self.base, self.size = base, size
        self.inverse = pow(base, -1, 1 << 64)
        self.down, self.up = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def powers(self, count: int) -> None:
        if len(self.up) < count:
            self.up, self.down = (
                np.cumprod(np.append(np.ones(1, np.uint64), np.full(count, x, np.uint64)), dtype=np.uint64)
                for x in (self.base, self.inverse))

    def __call__(self, values: np.ndarray) -> np.ndarray:
        found = [np.empty(0, np.uint64)]
        for start in range(0, len(values) - self.size + 1, _CHUNK):
            part = values[start:start + _CHUNK + self.size - 1]
            self.powers(len(part))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * self.down[:len(part)], dtype=np.uint64)])
            total = (sums[self.size:] - sums[:-self.size]) * self.up[self.size - 1:len(part)]
            total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            found.append(total ^ (total >> np.uint64(32)))
        return np.concatenate(found)


def merged(starts: np.ndarray, size: int) -> np.ndarray:
    """Maximal intervals, first and end, that windows at the ascending ``starts`` cover."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + size]))
    return np.stack([starts[new], starts[np.append(new[1:], len(starts)) - 1] + size], 1)


def _slice_windows(part: pa.RecordBatch, words: Words, rolling: tuple[Rolling, Rolling], size: int):
    """Orders and keys of a slice's distinct texts, by order; window starts, owners and hashes of those."""
    orders, keys = column(part, "order").to_pylist(), column(part, "key").to_pylist()
    first: dict[tuple[int, int], int] = {}
    for i, name in enumerate(zip(orders, keys)):
        first.setdefault(name, i)
    names = sorted(first)
    texts = column(part, "text")
    found = [numbers_of(texts[first[n]].cast(pa.binary()).as_py(), words) for n in names]
    lengths = np.array([len(x) for x in found], np.int64)
    numbers = np.concatenate(found) if found else np.empty(0, np.int64)
    first_word = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(names)), lengths)
    if len(numbers) < size:
        at = np.empty(0, np.int64)
    else:
        at = np.flatnonzero(owner[size - 1:] == owner[:len(owner) - size + 1])
    hashes = tuple(r(words.hashes(numbers, t))[at] if len(at) else np.empty(0, np.uint64) for t, r in enumerate(rolling))
    order = np.array([n[0] for n in names], np.int64)
    return order, np.array([n[1] for n in names], np.int64), at - first_word[owner[at]], owner[at], hashes


def _window_rows(texts: DataFrame, size: int, buckets: int) -> DataFrame:
    """For each slice, one row of windows for each bucket, and one of intervals that are known to go."""
    def pack(batches):
        words, rolling = Words(), tuple(Rolling(b, size) for b in _BASES)
        for batch in batches:
            for part in slices(batch, limit=_SLICE):
                if len(words) > _MEMO:
                    words = Words()
                order, key, start, owner, (high, low) = _slice_windows(part, words, rolling, size)
                turn = np.argsort(high, kind="stable")
                value, holder = high[turn], owner[turn]
                same = np.concatenate([[False], value[1:] == value[:-1]])[:len(value)]
                head = np.maximum.accumulate(np.where(same, 0, np.arange(len(value))))
                again = same & np.concatenate([[False], holder[1:] == holder[:-1]])[:len(value)]
                gone = np.zeros(len(value), bool)
                gone[turn] = again | (order[holder] > order[holder[head]])
                rows = [_known_row(order, key, start[gone], owner[gone], size)] if gone.any() else []
                sent = np.flatnonzero(~gone)
                bucket = ((low[sent] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                turn = np.argsort(bucket, kind="stable")
                sent, bucket = sent[turn], bucket[turn]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else []
                for low_cut, high_cut in zip(cuts[:-1], cuts[1:]):
                    mine = sent[low_cut:high_cut]
                    own, many = np.unique(owner[mine], return_counts=True)
                    rows.append((int(bucket[low_cut]), order[own].tobytes(), key[own].tobytes(), many.astype("<u4").tobytes(),
                                 high[mine].tobytes(), (low[mine] & np.uint64(255)).astype("u1").tobytes(), None))
                if rows:
                    # a slice's intervals go along with any of its windows
                    rows[0] = (int(order[0]) % buckets, *rows[0][1:]) if rows[0][0] is None else rows[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 7))],
                        names=["bucket", *_PACKED])

    return map_batches(texts, "bucket int" + "".join(f", {n} binary" for n in _PACKED), pack)


_PACKED = ("orders", "keys", "counts", "hashes", "extra", "spans")


def _known_row(order, key, start, owner, size):
    """The intervals of windows that have an earlier equal one in their slice, text by text."""
    place = np.argsort(owner, kind="stable")
    owners, first, many = np.unique(owner[place], return_index=True, return_counts=True)
    spans = [merged(start[place[f:f + n]], size) for f, n in zip(first, many)]
    return (None, order[owners].tobytes(), key[owners].tobytes(), np.array([len(s) for s in spans], "<u4").tobytes(),
            None, None, np.concatenate(spans).astype("<i8").tobytes())


def later_holders(value: np.ndarray, extra: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Which entries have an equal one with a smaller order."""
    turn = np.argsort(value)
    equal = value[turn][1:] == value[turn][:-1]
    several = turn[np.concatenate([equal, [False]]) | np.concatenate([[False], equal])] if len(value) else turn
    several = several[np.lexsort((order[several], extra[several], value[several]))]
    v, e, o = value[several], extra[several], order[several]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (e[1:] != e[:-1])])[:len(v)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    return several[o > o[head]]


def _group_of(orders: np.ndarray, keys: np.ndarray, groups: int) -> np.ndarray:
    mixed = (orders.astype(np.uint64) * np.uint64(_BASES[0])) ^ (keys.astype(np.uint64) * np.uint64(_BASES[1]))
    return ((mixed >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def _packed_by_group(orders: np.ndarray, keys: np.ndarray, owner: np.ndarray, values: np.ndarray, groups: int) -> Iterator[tuple]:
    """Group, orders, keys and counts of texts, and the values, for each group of texts; ``owner`` ascends."""
    group = _group_of(orders, keys, groups)[owner]
    turn = np.argsort(group, kind="stable")
    owner, values, group = owner[turn], values[turn], group[turn]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]]) if len(group) else np.empty(0, np.int64)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own, many = np.unique(owner[low:high], return_counts=True)
        yield int(group[low]), orders[own].tobytes(), keys[own].tobytes(), many.astype("<u4").tobytes(), values[low:high].tobytes()


def _answers(rows: DataFrame, buckets: int) -> DataFrame:
    """Hashes of windows and intervals of words that go, packed by groups of texts."""
    def batch_of(found: list[tuple], kind: str) -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in found], pa.int32()), *(pa.array([r[i] for r in found], pa.binary()) for i in range(1, 5))]
        nothing = pa.nulls(len(found), pa.binary())
        last = [columns[4], nothing] if kind == "hashes" else [nothing, columns[4]]
        return pa.RecordBatch.from_arrays([*columns[:4], *last], names=["group", *_ANSWER])

    def judge(batches):
        packed: list[tuple] = []
        for batch in batches:
            for row in zip(*(column(batch, n).to_pylist() for n in ("bucket", *_PACKED))):
                if row[6] is None:
                    packed.append(row)
                else:
                    orders, keys, counts = (np.frombuffer(row[i], kind) for i, kind in zip((1, 2, 3), ("<i8", "<i8", "<u4")))
                    spans = np.frombuffer(row[6], "<i8").reshape(-1, 2)
                    yield batch_of([*_packed_by_group(orders, keys, np.repeat(np.arange(len(counts)), counts), spans, buckets)], "spans")
        packed.sort(key=lambda row: row[0])
        while packed:
            last = len(packed) - 1
            while last and packed[last - 1][0] == packed[-1][0]:
                last -= 1
            mine = packed[last:]
            del packed[last:]
            orders, keys, counts, value, extra = (
                np.concatenate([np.frombuffer(r[i], kind) for r in mine]) for i, kind in zip(range(1, 6), ("<i8", "<i8", "<u4", "<u8", "u1")))
            run = np.repeat(np.arange(len(counts)), counts)
            gone = np.sort(later_holders(value, extra, orders[run]))  # entries of one run lie together
            found = [*_packed_by_group(orders, keys, run[gone], value[gone], buckets)]
            if found:
                yield batch_of(found, "hashes")

    return map_batches(rows.repartitionById(buckets, "bucket"), "group int" + "".join(f", {n} binary" for n in _ANSWER), judge)


_ANSWER = ("orders", "keys", "counts", "hashes", "spans")


def _by_text(answers: DataFrame, groups: int) -> DataFrame:
    """order and key of each text with its hashes and intervals."""
    def collect(batches):
        found: dict[tuple[int, int], tuple[list, list]] = {}
        for batch in batches:
            for orders, keys, counts, hashes, spans in zip(*(column(batch, n).to_pylist() for n in _ANSWER)):
                place, values, width = (0, hashes, 8) if spans is None else (1, spans, 16)
                at = 0
                for order, key, n in zip(*(np.frombuffer(x, k).tolist() for x, k in ((orders, "<i8"), (keys, "<i8"), (counts, "<u4")))):
                    found.setdefault((order, key), ([], []))[place].append(values[at:at + n * width])
                    at += n * width
        names = list(found)
        for start in range(0, len(names), 256):
            some = names[start:start + 256]
            lists = [found.pop(n) for n in some]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([n[i] for n in some], pa.int64()) for i in (0, 1)),
                 *(pa.array([b"".join(x[i]) for x in lists], pa.binary()) for i in (0, 1))], names=["order", "key", "hashes", "spans"])

    return map_batches(answers.repartitionById(groups, "group"), "order bigint, key bigint, hashes binary, spans binary", collect)


def _intervals(numbers: np.ndarray, words: Words, rolling: Rolling, hashes: bytes, spans: bytes) -> np.ndarray:
    """The maximal intervals of words that go, from the hashes of windows and known intervals."""
    change = np.zeros(len(numbers) + 1, np.int64)
    pairs = np.frombuffer(spans, "<i8").reshape(-1, 2)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 1], -1)
    if hashes:
        at = np.flatnonzero(np.isin(rolling(words.hashes(numbers, 0)), np.frombuffer(hashes, "<u8")))
        change[at] += 1
        change[at + rolling.size] -= 1
    covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    return np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)


def _finished(texts: DataFrame, size: int, with_text: bool) -> DataFrame:
    """The result of each row of doc_id, text, and its hashes and spans."""
    doc_id = texts.schema["doc_id"]
    out = T.StructType([T.StructField("doc_id", doc_id.dataType)] + [
        T.StructField(n, T.LongType()) for n in ("n_words", "n_removed", "n_spans")] + [
        T.StructField("kept_sha256", T.StringType())] + ([T.StructField("kept", T.BinaryType())] if with_text else []))

    def finish(batches):
        words, rolling = Words(), Rolling(_BASES[0], size)
        for batch in batches:
            for part in slices(batch):
                if len(words) > _MEMO:
                    words = Words()
                rows = []
                for text, hashes, spans in zip(texts_as_bytes(part), column(part, "hashes").to_pylist(), column(part, "spans").to_pylist()):
                    gone = np.empty((0, 2), np.int64)
                    if hashes or spans:
                        gone = _intervals(numbers_of(text, words), words, rolling, hashes or b"", spans or b"")
                    rows.append(_kept(text, gone, with_text))
                made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:4 + with_text])]
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), *made], names=out.names)

    return map_batches(texts, out, finish)


def _kept(text: bytes, gone: np.ndarray, with_text: bool) -> tuple:
    digest, left, base = hashlib.sha256(), [], 0
    removed, started = int((gone[:, 1] - gone[:, 0]).sum()), False
    for words in pieces(text):
        n = len(words)
        if len(gone):
            keep = np.ones(n, bool)
            for low, high in gone[(gone[:, 0] < base + n) & (gone[:, 1] > base)].tolist():
                keep[max(low - base, 0):high - base] = False
            words = [words[i] for i in np.flatnonzero(keep).tolist()]
        if words:
            joined = (b" " if started else b"") + b" ".join(words)
            digest.update(joined)
            started = True
            if with_text:
                left.append(joined)
        base += n
    return (base, removed, len(gone), digest.hexdigest(), *([b"".join(left)] if with_text else []))


def _order(docs: DataFrame) -> Column:
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"doc_id must be an integer column, not {kind.simpleString()}")
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID))


def remove_repeated_windows(docs: DataFrame, size: int = SIZE, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans (maximal removed intervals), kept_sha256 and, with ``with_text``, the kept words."""
    spark = docs.sparkSession
    long_enough = F.coalesce(F.octet_length("text"), F.lit(0)) >= 2 * size - 1
    text_key = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 16), 16, -10).cast("bigint")
    rows = docs.select("doc_id", "text", _order(docs).alias("order"))
    texts = rows.where(long_enough).withColumn("key", text_key)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    windows = _window_rows(texts.select("order", "key", "text"), size, buckets)
    answers = settle(_answers(windows, buckets), "repeated_windows")
    found = settle(_by_text(answers, buckets), "windows_by_text").select(
        F.col("order").alias("o"), F.col("key").alias("k"), "hashes", "spans")
    met = texts.join(found, (F.col("order") == F.col("o")) & (F.col("key") == F.col("k")), "left")
    none = F.lit(None).cast("binary")
    others = rows.where(~long_enough).select("doc_id", "text", none.alias("hashes"), none.alias("spans"))
    return _finished(met.select("doc_id", "text", "hashes", "spans").union(others), size, with_text)
