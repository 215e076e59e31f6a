"""Ranked lexical search: the best documents for each item, by inner products over norm buckets.

Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z is lower-cased.
With N documents that have a term, L terms in all of them, n in one, df documents with a term and tf of its
occurrences in one, a term weighs w = floor(1000 ln((2N+2)/(2df+1))), a document's m is
100 - 75 + (75 n N) div L, and its score sums w * ((1000000000 tf) div (1000 tf + 8 m)) over the item's terms,
repeats included. That is an inner product of the item's weights and the document's *impacts*, and it is searched as
one:

1. *Vectors.* One pass over the texts leaves, for each document, the terms that items use with their tf.
   N, L and df are summed over all documents.
2. *Norm buckets.* Impacts, times the root of w, are vectors whose lengths are known; they are written in
   descending order of length. Rows of a file that follow each other form a bucket.
3. *Thresholds.* The longest vectors are scored first. An item's tenth best score there is a threshold for the rest:
   no document below it can be in the result.
4. *Search.* Cauchy-Schwarz bounds a bucket's scores by the product of lengths; files and buckets below all thresholds
   are not read further. In the others, the largest impact of each term bounds the bucket's scores again, and
   inside, an item's heaviest coordinates are added up and the rest is bounded by what is left of both lengths.
   Survivors are scored in integers; ties at the threshold survive. Each task keeps its ten best of an item, from which
   the ten best of all are taken.

Items are taken in blocks of bounded size, each with its own passes; within a block nothing depends on the number of
items but the terms that are broadcast. Rows of one item_id count as one item: equal ones once, different
texts together. Every document row is a document, also with a repeated doc_id; among equal scores null ids come last.
Null, empty and term-less texts match nothing, and items without terms have no result. Items with a null id are one
item. Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import column, map_batches, pieces, settle, slices, texts_as_bytes
from lakeops.session import materialise

BEST = 10
#: Vectors that make up a bucket.
BUCKET = 2048
#: Number of the longest vectors, about, from which the first thresholds come.
FIRST = 4096
#: Text of the items that are searched for at once.
BLOCK_BYTES = 8 << 20
#: Part of an item's squared length that its heaviest coordinates make up at least.
FOCUS = 0.9
#: Bounds in floating point are taken a little wider.
_SLACK = 1 + 1e-9

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a list for each few megabytes."""
    return pieces(text.translate(_TABLE))


def _vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n, and the numbers and counts of ``terms`` of each document that has any term at all."""
    vocabulary = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})
    size = len(terms)

    def count(batches):
        number = vocabulary.value.get
        for batch in batches:
            for part in slices(batch):
                kept, lengths, codes, counts = [], [], [], []
                for i, text in enumerate(texts_as_bytes(part)):
                    n, found = 0, np.zeros(0, np.int64)
                    for words in terms_of(text):
                        n += len(words)
                        own = np.fromiter((number(w, size) for w in words), np.int64, len(words))
                        found = own if not len(found) else np.concatenate([found, own])
                    if n:
                        code, tf = np.unique(found[found < size], return_counts=True)
                        kept.append(i)
                        lengths.append(n)
                        codes.append(code.astype("<u4").tobytes())
                        counts.append(tf.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id").take(pa.array(kept, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.array(codes, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "n", "terms", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), f"doc_id {kind}, n bigint, terms binary, counts binary", count)


def _document_frequencies(vectors: DataFrame, size: int) -> dict[int, int]:
    """Documents with each term; one line for each term and task is sent."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for found in column(batch, "terms").to_pylist():
                total[np.frombuffer(found, "<u4")] += 1
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["term", "df"])

    rows = map_batches(vectors.select("terms"), "term bigint, df bigint", count).groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in rows.collect()}


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def impacts(counts: np.ndarray, n: int, documents: int, total: int) -> np.ndarray:
    m = 100 - 75 + 75 * n * documents // total
    tf = counts.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _by_length(vectors: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """doc_id, length, terms and impacts, the longest vectors first; those without weight are no candidates."""
    def measure(batches):
        root = np.sqrt(weights.astype(float))
        for batch in batches:
            kept, lengths, codes, values = [], [], [], []
            for i, (n, found, counts) in enumerate(zip(*(column(batch, c).to_pylist() for c in ("n", "terms", "counts")))):
                code = np.frombuffer(found, "<u4")
                value = impacts(np.frombuffer(counts, "<u4"), n, documents, total)
                length = float(np.linalg.norm(value * root[code]))
                if length > 0:
                    kept.append(i)
                    lengths.append(length)
                    codes.append(found)
                    values.append(value.astype("<u4").tobytes())
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(at), column(batch, "salt").take(at), pa.array(lengths, pa.float64()),
                 pa.array(codes, pa.binary()), pa.array(values, pa.binary())], names=["doc_id", "salt", "length", "terms", "impacts"])

    kind = vectors.schema["doc_id"].dataType.simpleString()
    rows = map_batches(vectors.select("doc_id", "salt", "n", "terms", "counts"),
                       f"doc_id {kind}, salt bigint, length double, terms binary, impacts binary", measure)
    order = [F.col("length").desc(), F.col("salt").asc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")


@dataclass
class Query:
    """An item: its terms, heaviest coordinate first, with exact weights, coordinates, and the lengths that remain."""
    terms: np.ndarray
    weights: np.ndarray
    coordinates: np.ndarray
    rest: np.ndarray
    focus: int

    @classmethod
    def build(cls, counts: Counter, number: dict[bytes, int], weights: np.ndarray) -> Query:
        terms = np.array([number[t] for t in counts], np.int64)
        times = np.array(list(counts.values()), np.int64)
        coordinates = times * np.sqrt(weights[terms].astype(float))
        order = np.argsort(-coordinates, kind="stable")
        squares = coordinates[order] ** 2
        rest = np.sqrt(np.append(np.cumsum(squares[::-1])[::-1], 0.0))
        focus = int(np.searchsorted(np.cumsum(squares), FOCUS * squares.sum())) + 1
        return cls(terms[order], (times * weights[terms])[order], coordinates[order], rest, min(focus, len(terms)))


class Bucket:
    """Vectors of similar length, by document and by term."""

    def __init__(self, lengths: np.ndarray, terms: list[np.ndarray], values: list[np.ndarray], roots: np.ndarray) -> None:
        self.lengths = lengths
        sizes = np.array([len(t) for t in terms], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.terms, self.values = np.concatenate(terms).astype(np.int64), np.concatenate(values).astype(np.int64)
        order = np.argsort(self.terms, kind="stable")
        self.by_term = self.terms[order]
        self.rows = np.repeat(np.arange(len(lengths)), sizes)[order]
        self.coordinates = self.values[order] * roots[self.by_term]
        there = np.flatnonzero(np.concatenate([[True], self.by_term[1:] != self.by_term[:-1]]))
        self.first = np.zeros(len(roots) + 1, np.int64)
        self.first[self.by_term[there]] = np.diff(np.append(there, len(order)))
        self.first = np.concatenate([[0], np.cumsum(self.first[:-1])])
        self.largest = np.zeros(len(roots))
        self.largest[self.by_term[there]] = np.maximum.reduceat(self.coordinates, there)

    def candidates(self, query: Query, threshold: int) -> np.ndarray:
        """The rows whose score may reach the threshold."""
        most = query.coordinates * self.largest[query.terms]
        if most.sum() * _SLACK < threshold:
            return np.empty(0, np.int64)
        score, squares = np.zeros(len(self.lengths)), np.zeros(len(self.lengths))
        for term, coordinate in zip(query.terms[:query.focus].tolist(), query.coordinates[:query.focus].tolist()):
            at = slice(self.first[term], self.first[term + 1])
            own = self.coordinates[at]
            score[self.rows[at]] += coordinate * own
            squares[self.rows[at]] += own * own
        left = np.sqrt(np.maximum(self.lengths ** 2 * _SLACK - squares, 0)) * query.rest[query.focus]
        return np.flatnonzero((score + np.minimum(left, most[query.focus:].sum())) * _SLACK >= threshold)

    def scores(self, rows: np.ndarray, query: Query, dense: np.ndarray) -> np.ndarray:
        """Exact scores; ``dense`` is all zero before and after."""
        dense[query.terms] = query.weights
        sizes = self.ends[rows] - self.starts[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        found = np.add.reduceat(dense[self.terms[at]] * self.values[at], ends - sizes)
        dense[query.terms] = 0
        return found


def _place(entry: tuple) -> tuple:
    score, doc_id = entry
    return -score, doc_id is None, doc_id if doc_id is not None else 0


def _search(vectors: DataFrame, queries: list[Query], weights: np.ndarray, thresholds: np.ndarray, best: int, kind: T.DataType) -> DataFrame:
    """number of the item, doc_id and score of the best of each task that reach the thresholds."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, thresholds))
    out = T.StructType([T.StructField("item", T.LongType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def buckets(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "length", "terms", "impacts"))):
                held.append(row)
                if len(held) == BUCKET:
                    yield held
                    held = []
        if held:
            yield held

    def search(batches):
        own, start = shared.value
        least = start.copy()
        roots = np.sqrt(weights.astype(float))
        dense = np.zeros(len(weights), np.int64)
        lengths = np.array([q.rest[0] for q in own])
        found: list[list[tuple]] = [[] for _ in own]
        for rows in buckets(batches):
            ids = [r[0] for r in rows]
            length = np.array([r[1] for r in rows])
            wanted = np.flatnonzero(lengths * length.max() * _SLACK >= least)
            if not len(wanted):
                continue
            bucket = Bucket(length, [np.frombuffer(r[2], "<u4") for r in rows], [np.frombuffer(r[3], "<u4") for r in rows], roots)
            for number in wanted.tolist():
                query = own[number]
                near = bucket.candidates(query, int(least[number]))
                if not len(near):
                    continue
                scores = bucket.scores(near, query, dense)
                good = scores >= least[number]
                entries = found[number] + [(s, ids[i]) for s, i in zip(scores[good].tolist(), near[good].tolist())]
                entries.sort(key=_place)
                found[number] = entries[:best]
                if len(entries) >= best:
                    least[number] = max(least[number], entries[best - 1][0])
        flat = [(number, doc_id, score) for number, entries in enumerate(found) for score, doc_id in entries]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in flat], pa.int64()), pa.array([r[1] for r in flat], id_type),
                                          pa.array([r[2] for r in flat], pa.int64())], names=["item", "doc_id", "score"])

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    return map_batches(vectors, out, search)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """item_id and counts of terms of each item, in blocks that are collected one by one."""
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    if count > 1:
        rows = materialise(rows, "items")
    for number in range(count):
        found: dict[object, Counter] = {}
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == number) if count > 1 else rows
        for row in part.collect():
            own = found.setdefault(row["item_id"], Counter())
            for words in terms_of(row["text"].encode()):
                own.update(words)
        yield [(item, own) for item, own in found.items() if own]


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``best`` documents with a score above 0 of each item."""
    results = None
    for block in _blocks(items, block_bytes):
        found = _block_results(docs, items, block, best)
        results = found if results is None else results.union(found)
    return _ranked(results, "item_id", best).select("item_id", "rank", "doc_id", "score")


def _ranked(found: DataFrame, item: str, best: int) -> DataFrame:
    place = Window.partitionBy(item).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)


def _block_results(docs: DataFrame, items: DataFrame, block: list[tuple], best: int) -> DataFrame:
    spark, id_kind, item_kind = docs.sparkSession, docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    out = T.StructType([T.StructField("item_id", item_kind), T.StructField("doc_id", id_kind), T.StructField("score", T.LongType())])
    terms = sorted(set().union(*[own for _, own in block]))
    vectors = settle(_vectors(docs, terms).withColumn("salt", F.monotonically_increasing_id()), "term_vectors")
    documents, total = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents or not terms:
        return spark.createDataFrame([], out)
    frequency = _document_frequencies(vectors, len(terms))
    weights = np.array([weight(documents, frequency.get(i, 0)) for i in range(len(terms))], np.int64)
    number = {t: i for i, t in enumerate(terms)}
    queries = [Query.build(own, number, weights) for _, own in block]
    lasting = settle(_by_length(vectors, weights, documents, total), "norm_buckets")
    thresholds = np.ones(len(queries), np.int64)
    long = lasting.agg(F.percentile_approx("length", max(0.0, 1 - FIRST / documents))).first()[0] or 0.0
    first = _search(lasting.where(F.col("length") >= long), queries, weights, thresholds, best, id_kind)
    for row in _ranked(first, "item", best).where(F.col("rank") == best).select("item", F.col("score").alias("least")).collect():
        thresholds[row["item"]] = row["least"]
    # no document whose length is below this reaches any item's threshold
    least = float(np.min(thresholds / np.maximum([q.rest[0] for q in queries], 1e-300))) / _SLACK
    found = _search(lasting.where(F.col("length") >= least), queries, weights, thresholds, best, id_kind)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)],
                                  T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_kind)]))
    return settle(found.join(names, "item").select("item_id", "doc_id", "score"), "lexical_results")
