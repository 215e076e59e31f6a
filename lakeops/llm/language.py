"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of characters that are no letters becomes one space, and all
1- to ``ORDERS``-grams are hashed into ``buckets`` counters. Spark adds up the counters by language;
the log-probability matrix (buckets x languages, fixed size) goes to the executors, and each whole
text is scored there as a sparse product of its counters with the matrix.

The model is fitted on at most about ``max_train`` labelled documents, chosen by a hash of their id;
everything else covers all rows. Texts that are null or have no letter get ``und`` and score 0, and
so does every text if nothing could be learned. Languages that tie: the first in order of text.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import column, map_batches, slices, texts_as_bytes

ORDERS = 3
BUCKETS = 1 << 14
#: Labelled documents that the model is fitted on.
MAX_TRAIN = 50_000
#: Languages that a model may have; more is a fault in the labels.
MAX_LANGUAGES = 1_000
UNDETERMINED = "und"
_SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: bytes, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text has grams in, and how many; none if it has no letter."""
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.where(letter, codes, np.uint32(_SPACE))
    codes = codes[np.concatenate([[True], letter[1:] | letter[:-1]])]
    shift = np.uint32(32 - buckets.bit_length() + 1)
    single = codes * np.uint32(0x9E3779B1)
    state, found = single, []
    for order in range(1, min(ORDERS, len(codes)) + 1):
        if order > 1:
            state = (state[:-1] * np.uint32(0x85EBCA6B) + np.uint32(order)) ^ single[order - 1:]
        found.append(((state ^ (state >> np.uint32(15))) * np.uint32(0xC2B2AE35)) >> shift)
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=buckets)
    places = np.flatnonzero(counts)
    return places, counts[places]


class Model:
    """Languages in order, their log-priors and the log-probability matrix."""

    def __init__(self, languages: list[str], docs: np.ndarray, counts: np.ndarray, smoothing: float = 0.5) -> None:
        self.languages = languages
        self.prior = np.log(docs / max(1, docs.sum())) if languages else np.empty(0)
        smooth = counts + smoothing
        self.matrix = np.log(smooth / smooth.sum(0, keepdims=True))

    def predict(self, text: bytes) -> tuple[str, float]:
        places, counts = gram_counts(text, len(self.matrix))
        if not len(places) or not self.languages:
            return UNDETERMINED, 0.0
        score = counts @ self.matrix[places] + self.prior
        best = int(score.argmax())
        return self.languages[best], float(1 / np.exp(score - score[best]).sum())


def fit(docs: DataFrame, max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> Model:
    """Learn from ``text`` and non-null ``lang`` of ``docs``."""
    labelled = docs.where("lang is not null").select("doc_id", "lang", "text")
    every = -(-labelled.count() // max_train) or 1
    chosen = labelled.where(F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(every)) == 0)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(column(part, "lang").to_pylist(), texts_as_bytes(part)):
                    own = totals.setdefault(lang, np.zeros(buckets + 1, np.int64))
                    places, counts = gram_counts(text, buckets)
                    own[places] += counts
                    own[buckets] += 1  # documents
        for lang, own in totals.items():
            places = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int32()), pa.array(own[places], pa.int64())],
                names=["lang", "bucket", "n"])

    rows = map_batches(chosen, "lang string, bucket int, n bigint", count)
    totals = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # at most (buckets + 1) x MAX_LANGUAGES sums of counters reach the driver
    sums = totals.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    found = sums.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    matrix = np.zeros((buckets + 1, len(found)))
    for i, row in enumerate(found):
        for bucket, n in row["counts"]:
            matrix[bucket, i] = n
    return Model([row["lang"] for row in found], matrix[buckets], matrix[:buckets])


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns named in ``keep``, lang_pred and score of every document."""
    passed = [c for c in keep or [] if c not in ("doc_id", "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select("doc_id", *passed, *([] if "text" in passed else ["text"]))

    def score(batches):
        for batch in batches:
            for part in slices(batch):
                found = [shared.value.predict(t) for t in texts_as_bytes(part)]
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, n) for n in ["doc_id", *passed]), pa.array([x[0] for x in found], pa.string()),
                     pa.array([x[1] for x in found], pa.float64())], names=["doc_id", *passed, "lang_pred", "score"])

    own = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in ["doc_id", *passed])
    return map_batches(read, f"{own}, lang_pred string, score double", score)


def identify(docs: DataFrame, held_out: Column, keep: list[str] | None = None) -> DataFrame:
    """``predict`` with a model that never sees the rows where ``held_out`` holds; adds that flag."""
    model = fit(docs.where(~held_out))
    return predict(docs, model, keep).withColumn("held_out", held_out)
