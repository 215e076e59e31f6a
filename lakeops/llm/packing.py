"""Best-fit packing by bin completion.

Pieces of equal length are interchangeable, so the search runs on the number of pieces of each
length, which is bounded by the length of a sequence and not by the corpus. Each node of the search
takes the longest piece that is left, enumerates undominated fillings of the room beside it (a
filling is dominated if some of its pieces could be exchanged for one other piece that leaves no
more waste), and uses a filling as often as the counts allow. Branches are pruned by the waste
bound of Martello and Toth; best-fit-decreasing gives the first incumbent. The search ends when the
incumbent meets the bound, or after ``NODES`` nodes with the best packing found.

The result is a short list of patterns. Every piece finds its own place in it from its number among
the pieces of its length, without any shuffle of tokens.

Null and empty texts are one closing token. Repeated rows of one doc_id are packed as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import column, map_batches, settle, slices, texts_as_bytes, with_rank

CAPACITY = 4096
#: The token that closes each document.
CLOSING = 1
#: Nodes of the search; steps that one node may take to enumerate fillings; fillings that it tries.
NODES, STEPS, WIDTH = 6_000, 400, 4
#: Words, and runs, that one memory holds; it holds as many words that it met before.
_KNOWN_LIMIT = 250_000

#: (length, how many of them) of one sequence, and how many sequences look so.
Pattern = tuple[tuple[tuple[int, int], ...], int]


#: Characters that the tokenizer neither recomposes nor joins in contractions: ASCII marks but the
#: apostrophe, and the letters of Latin-1.
_PLAIN = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_RUNS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+").findall
#: The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHIFTED = dict(zip((b for b in range(256) if b not in _SHOWN), map(chr, range(256, 512))))


class WordIds(dict):
    """The ids, as little-endian bytes, of each word. Words are what stands between blanks and line
    ends, which this tokenizer drops and never joins across. Plain words go straight to its merges,
    run by run; all others through the whole of it. When the memory is full, words not met since it was
    last full are forgotten."""

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _KNOWN_LIMIT:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                ids = self.of_run(word.lower())
            elif _PLAIN(word) and "<|" not in word:
                ids = b"".join(map(self.of_run, _RUNS(word.lower())))
            else:
                ids = np.array(self.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def of_run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            if len(self.runs) >= _KNOWN_LIMIT:
                self.runs.clear()
            shown = run if run.isascii() else run.encode().decode("latin-1").translate(_SHIFTED)
            found = [t.id for t in self.merge(shown)]
            ids = self.runs[run] = pack_ids(f"<{len(found)}I", *found)
        return ids

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def word_ids(path: str) -> WordIds:
    """One memory for all tasks of a worker."""
    return WordIds(path)


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length and the ids as little-endian uint32."""
    closing = np.array([CLOSING], "<u4").tobytes()

    def cut(batches):
        known = word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                for i, text in enumerate(texts_as_bytes(part)):
                    ids = known.of_text(text.decode("utf-8", "replace")) + closing
                    for number, start in enumerate(range(0, len(ids), 4 * capacity)):
                        rows.append((i, number, start // 4, ids[start:start + 4 * capacity]))
                yield pa.RecordBatch.from_arrays([
                    column(part, "doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([len(r[3]) // 4 for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"),
                       f"doc_id {kind}, piece int, start bigint, length bigint, ids binary", cut)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """The bound of Martello and Toth on the number of sequences; ``counts`` by length."""
    lengths = np.arange(capacity + 1)
    number, mass = np.cumsum(counts), np.cumsum(counts * lengths)
    half = capacity // 2
    k = np.arange(0, half + 1)
    alone = number[-1] - number[capacity - k]
    paired = number[capacity - k] - number[half]
    room = paired * capacity - (mass[capacity - k] - mass[half])
    small = mass[half] - np.where(k > 0, mass[np.maximum(k - 1, 0)], 0)
    return int((alone + paired + np.maximum(0, -(-(small - room) // capacity))).max())


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit-decreasing over counts: pieces of one length fill the bins of one shape together."""
    shapes: dict[int, list[list]] = {}  # room left -> [pattern, number of bins]
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            room = min((r for r in shapes if r >= length), default=None)
            if room is None:
                per = capacity // length
                pattern, bins, room = (), -(-left // per), capacity
            else:
                pattern, bins = shapes[room].pop()
                if not shapes[room]:
                    del shapes[room]
                per = room // length
            full = min(bins, left // per)
            if full:
                shapes.setdefault(room - per * length, []).append([(*pattern, (length, per)), full])
                left -= full * per
                bins -= full
            if left and bins:
                shapes.setdefault(room - left * length, []).append([(*pattern, (length, left)), 1])
                left, bins = 0, bins - 1
            if bins and pattern:
                shapes.setdefault(room, []).append([pattern, bins])
    return [(pattern, bins) for group in shapes.values() for pattern, bins in group]


def fillings(counts: np.ndarray, room: int, lengths: list[int]) -> list[tuple[tuple[int, int], ...]]:
    """Undominated fillings of ``room``, the fullest first; at most WIDTH of them."""
    if room <= 0:
        return [()]
    if counts[room] > 0:
        return [((room, 1),)]  # it dominates every other filling
    usable = [x for x in lengths if x <= room and counts[x] > 0]
    found: dict[tuple, int] = {}
    steps = 0
    # depth first, the longest pieces first; an entry is (place in usable, room, chosen)
    stack = [(0, room, ())]
    while stack and steps < STEPS:
        steps += 1
        at, left, chosen = stack.pop()
        while at < len(usable) and usable[at] > left:
            at += 1
        if at == len(usable) or left == 0:
            found[chosen] = left
            if left == 0 and sum(1 for v in found.values() if v == 0) >= WIDTH:
                break
            continue
        length = usable[at]
        most = min(int(counts[length]), left // length)
        for number in range(0 if len(usable) - at > 1 else most, most + 1):
            rest = left - number * length
            stack.append((at + 1, rest, (*chosen, (length, number)) if number else chosen))
    ordered = sorted(found.items(), key=lambda f: (f[1], [-x for pair in f[0] for x in pair]))
    kept = [chosen for chosen, waste in ordered[:4 * WIDTH] if not _dominated(counts, chosen, waste)]
    return kept[:WIDTH] or [ordered[0][0]]


def _dominated(counts: np.ndarray, chosen: tuple[tuple[int, int], ...], waste: int) -> bool:
    """Whether up to three of the pieces could be exchanged for one piece that fits in their place and the waste."""
    used = dict(chosen)
    pieces = [x for x, n in chosen for _ in range(min(n, 3))][:12]
    for size in (1, 2, 3):
        for some in combinations(pieces, size):
            low = sum(some)
            for other in range(low + (size == 1), min(low + waste, len(counts) - 1) + 1):
                if counts[other] > used.get(other, 0):
                    return True
    return False


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold exactly ``counts`` pieces of each length, in as few sequences as were found."""
    best = best_fit_decreasing(counts, capacity)
    incumbent, floor = sum(n for _, n in best), least_sequences(counts, capacity)
    if incumbent <= floor:
        return best
    left = counts.copy()
    path: list[Pattern] = []
    used = 0
    trail: list[Iterator] = []

    def children() -> Iterator[Pattern]:
        lengths = np.flatnonzero(left)[::-1].tolist()
        longest = lengths[0]
        left[longest] -= 1
        options = fillings(left, capacity - longest, lengths)
        left[longest] += 1
        for option in options:
            shape = dict(option)
            shape[longest] = shape.get(longest, 0) + 1
            times = min(int(left[x]) // n for x, n in shape.items())
            yield tuple(sorted(shape.items(), reverse=True)), times

    trail.append(children())
    while trail and nodes:
        step = next(trail[-1], None)
        if step is None:
            trail.pop()
            if path:
                shape, times = path.pop()
                used -= times
                for x, n in shape:
                    left[x] += n * times
            continue
        nodes -= 1
        shape, times = step
        for x, n in shape:
            left[x] -= n * times
        path.append(step)
        used += times
        if not left.any():
            if used < incumbent:
                best, incumbent = list(path), used
                if incumbent <= floor:
                    break
        elif used + least_sequences(left, capacity) < incumbent:
            trail.append(children())
            continue
        path.pop()
        used -= times
        for x, n in shape:
            left[x] += n * times
    return best


class Places:
    """Where the n-th piece of a length goes: runs of numbers, each with a pattern, in sorted arrays."""

    SHIFT = 44

    def __init__(self, patterns: list[Pattern]) -> None:
        given: dict[int, int] = {}
        runs, first = [], 0
        for shape, times in patterns:
            offset = 0
            for length, number in sorted(shape, reverse=True):
                start = given.get(length, 0)
                runs.append((length << self.SHIFT | start, first, number, offset, start))
                given[length] = start + number * times
                offset += length * number
            first += times
        runs.sort()
        self.keys, self.first, self.number, self.offset, self.start = (
            np.array([r[i] for r in runs], np.int64) for i in range(5))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence and the place in it of each piece."""
        at = np.searchsorted(self.keys, lengths << self.SHIFT | ranks, "right") - 1
        sequence, turn = np.divmod(ranks - self.start[at], self.number[at])
        return self.first[at] + sequence, self.offset[at] + turn * lengths


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``, 1 to ``capacity``) and for each its ``sequence_id`` and ``offset``."""
    ranked = with_rank(pieces, "length", "_rank", "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # one row for each length
        counts[row["length"]] = row["n"]
    places = pieces.sparkSession.sparkContext.broadcast(Places(bin_completion(counts, capacity)))
    names = pieces.columns

    def place(batches):
        for batch in batches:
            lengths, ranks = (column(batch, n).to_numpy() for n in ("length", "_rank"))
            sequence, offset = places.value.find(lengths, ranks)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, n) for n in names), pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_batches(ranked, f"{own}, sequence_id bigint, offset bigint", place)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the CRC-32 of their ids and their places."""
    pieces = tokenize(docs, tokenizer, capacity)
    # written down first: two Python functions in one stage would keep two workers, and their memory, for each task
    pieces = settle(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, capacity)
