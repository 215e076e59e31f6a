"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text is cut into runs of letters, of digits and of other marks. Each run counts as itself and by
its shape (lower case, capitalised, upper case, digits, marks), alone and with its successor, hashed
into ``2 ** DIMENSION_BITS`` weights; a run that repeats the one before it, or the one before that,
counts as a repetition, whatever it is. Values are square roots of counts, scaled to length 1. The weights are learned by
FTRL-proximal, whose L1 term leaves most of them zero, and go to the executors, where every whole
text is scored as a sparse dot product.

The model is fitted in one task on at most about ``MAX_TRAIN`` labelled rows, chosen by a hash of
their id and taken in the order of that hash; everything else covers all rows. Null and empty texts
have no features and get the score of the bias alone. A document with several labels counts once for
each; null labels are ignored. Without any labels every score is 0.5.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import column, map_batches, slices, texts_as_bytes

DIMENSION_BITS = 18
#: Labelled rows that the model is fitted on.
MAX_TRAIN = 10_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.1
_RUN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
_KNOWN_LIMIT = 250_000
_known: dict[bytes, int] = {}


def _shape(run: bytes) -> int:
    text = run.decode("utf-8", "replace")
    if not text[0].isalpha():
        return 4 if text[0].isdigit() else 5
    if text.islower():
        return 1
    return 3 if len(text) > 1 and text.isupper() else 2


def _number(run: bytes) -> int:
    """Hash and shape of a run, remembered for the runs that come often."""
    number = _known.get(run)
    if number is None:
        if len(_known) >= _KNOWN_LIMIT:
            _known.clear()
        number = _known[run] = zlib.crc32(run) << 3 | _shape(run)
    return number


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the features of a text; place 0 is the bias."""
    runs = _RUN.findall(text)
    numbers = np.fromiter(map(_number, runs), np.uint64, len(runs))
    top = np.uint64(64 - DIMENSION_BITS)
    mix, step = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
    shapes = numbers & np.uint64(7)
    pairs = numbers[:-1] * step + numbers[1:]
    again = numbers[:-2] == numbers[2:]
    all_of = np.concatenate([
        numbers, np.where(numbers[:-1] == numbers[1:], np.uint64(3), pairs), np.full(again.sum(), 5, np.uint64), shapes + np.uint64(1 << 50),
        shapes[:-1] * np.uint64(8) + shapes[1:] + np.uint64(1 << 51)])
    places, counts = np.unique((((all_of ^ (all_of >> np.uint64(29))) * mix) >> top).astype(np.int64), return_counts=True)
    values = np.sqrt(counts)
    norm = np.sqrt((values * values).sum())
    return np.concatenate([[0], places]), np.concatenate([[1.0], values / norm if norm else values])


class Leader:
    """FTRL-proximal with a learning rate for each weight."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << DIMENSION_BITS), np.zeros(1 << DIMENSION_BITS)

    def weights(self, places: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(places)
        slope = (_squash(weights @ values) - label) * values
        squares = slope * slope
        self.z[places] += slope - (np.sqrt(self.n[places] + squares) - np.sqrt(self.n[places])) / ALPHA * weights
        self.n[places] += squares


def _squash(value: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(value, -35, 35))))


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, max_train: int = MAX_TRAIN) -> np.ndarray:
    """The weights, from documents whose id passes ``learnable`` and their ``labels.quality``."""
    marked = labels.where(learnable & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    every = -(-marked.count() // max_train) or 1
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = marked.where(F.pmod(order, F.lit(every)) == 0)
    rows = (docs.select("doc_id", "text").join(chosen, "doc_id")
                .repartition(1).sortWithinPartitions(order, "doc_id", "quality", "text"))

    def learn(batches):
        seen = []
        for batch in batches:
            for part in slices(batch):
                seen += [(*features(t), q) for t, q in zip(texts_as_bytes(part), column(part, "quality").to_pylist())]
        leader = Leader()
        for _ in range(EPOCHS):
            for places, values, label in seen:
                leader.learn(places, values, label)
        weights = leader.weights(slice(None))
        places = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(weights[places])], names=["place", "weight"])

    # at most 2 ** DIMENSION_BITS weights
    found = map_batches(rows, "place bigint, weight double", learn).collect()
    weights = np.zeros(1 << DIMENSION_BITS)
    weights[[r["place"] for r in found]] = [r["weight"] for r in found]
    return weights


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def dot(batches):
        for batch in batches:
            for part in slices(batch):
                scores = [_squash(shared.value[p] @ v) for p, v in map(features, texts_as_bytes(part))]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(scores, pa.float64()),
                     pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), f"doc_id {kind}, score double, predicted int", dot)
