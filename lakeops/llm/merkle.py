"""Merkle manifest: hash trees of fanout 16 over the documents of each source, and one tree over the sources.

A leaf is the SHA-256 of a document's columns. Leaves of a source ascend by doc_id (null ids last); runs of
``FANOUT`` become their hash, level by level, until one is left, the subroot. Subroots ascend by source (null
first, then bytewise) and likewise give the root. Digests are hashed as lowercase hex text.

The trees are evaluated by *time-forward processing*. Nodes are labelled so that children precede parents, and
each node sends its digest ahead to its parent through a priority queue ordered by label. Between tasks the
queue is a shuffle sorted by label, which Spark keeps on disk as needed; blocks of ``FANOUT ** LEVELS`` nodes, one
subtree each, are swept inside a task with a heap that never holds more than the block. Each round leaves one
node of a block, so a thousand million leaves take three rounds. A *reversed sweep* runs the labels backwards:
a parent hands every child its proof suffix, the runs on the way to the root with the place in each, and a
child puts its own run in front.

Nothing but a block is ever in one place: a source with a third of all documents has many blocks, and repeated
rows, ordered by a number that is written down first, are dealt over tasks like others. Repeated rows are leaves
of their own; which of two equal rows comes first makes no difference to what they return together. Null columns
hash as ``-``. An empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import map_batches, settle

FANOUT = 16
#: Levels that one round folds; a block has at most FANOUT ** LEVELS nodes.
LEVELS = 3
BLOCK = FANOUT ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33

Run = list[bytes]
#: What leads from a node to the root: its place in a run, and the run, from the lowest level up.
Path = list[tuple[int, Run]]


def digest(parts: Run) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _field(value: Column) -> Column:
    shown = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_of(**changed: Column) -> Column:
    """The leaf of a row, with some of its columns ``changed``."""
    return F.sha2(F.concat(*[_field(changed.get(f, F.col(f))) for f in FIELDS]).cast("binary"), 256)


def depth(nodes: int) -> int:
    """Levels above ``nodes`` siblings, as many as one round folds at most."""
    levels = 0
    while nodes > 1 and levels < LEVELS:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def forward(digests: Run, levels: int) -> tuple[bytes, dict[tuple[int, int], Run]]:
    """The digest of the node ``levels`` above a block, and the runs below each inner node by its label."""
    if not levels:
        return digests[0], {}
    queue: list[tuple[tuple[int, int], int, bytes]] = []
    for i, value in enumerate(digests):
        heappush(queue, ((1, i // FANOUT), i, value))
    runs: dict[tuple[int, int], Run] = {}
    value = b""
    while queue:
        label = level, index = queue[0][0]
        run = []
        while queue and queue[0][0] == label:
            run.append(heappop(queue)[2])
        runs[label], value = run, digest(run)
        if level < levels:
            heappush(queue, ((level + 1, index // FANOUT), index, value))
    return value, runs


def backward(size: int, runs: dict[tuple[int, int], Run], above: Path) -> list[Path]:
    """The path of each node of a block to the root; ``above`` is that of the node on its top."""
    if not runs:
        return [above] * size
    suffix: dict[tuple[int, int], Path] = {max(runs): above}
    for label in sorted(runs, reverse=True):
        level, index = label
        rest = suffix.pop(label)
        for place in range(len(runs[label])):
            suffix[level - 1, index * FANOUT + place] = [(place, runs[label]), *rest]
    return [suffix[0, i] for i in range(size)]


def fold(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf gives with the siblings of its path."""
    for place, run in path:
        leaf = digest([*run[:place], leaf, *run[place + 1:]])
    return leaf


def proof(path: Path) -> bytes:
    """The hash of all siblings of a path, from the leaf's run up, each from left to right."""
    return digest([x for place, run in path for x in (*run[:place], *run[place + 1:])])


def _packed(path: Path) -> bytes:
    return b"".join(bytes([place, len(run)]) + bytes.fromhex(b"".join(run).decode()) for place, run in path)


def _unpacked(data: bytes) -> Path:
    path, at = [], 0
    while at < len(data):
        place, size = data[at], data[at + 1]
        path.append((place, [data[at + 2 + 32 * i:at + 34 + 32 * i].hex().encode() for i in range(size)]))
        at += 2 + 32 * size
    return path


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one group and block after the other; they arrive sorted by these, first two columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _chunks(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), schema.types)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Whole blocks in one task each, in the order of their labels."""
    return rows.repartition("group", "block").sortWithinPartitions("group", "block", *order)


_NODES = pa.schema([("group", pa.int64()), ("index", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_PATHS = pa.schema([("group", pa.int64()), ("index", pa.int64()), ("subroot", pa.string()), ("above", pa.binary())])


def _folded(nodes: DataFrame) -> DataFrame:
    """One node for each block: group, index, n (nodes of the group at this round) and digest."""
    def sweep(batches):
        def rows():
            for block in _blocks(batches):
                group, index, _, n, _ = block[0]
                top, _ = forward([row[4].encode() for row in block], depth(n))
                yield group, index, -(-n // BLOCK), top.decode()
        return _chunks(rows(), _NODES)

    sent = _dealt(nodes.select("group", F.expr(f"index div {BLOCK}").alias("block"), "index", "n", "digest"), "index")
    return map_batches(sent, "group bigint, index bigint, n bigint, digest string", sweep)


def _tower(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each round, from the leaves of all groups to their roots."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(settle(_folded(rounds[-1]), "merkle_nodes"))
        most = -(-most // BLOCK)
    return rounds


def _with_above(nodes: DataFrame, paths: DataFrame, *carried: str) -> DataFrame:
    """Each block with the path of its top in front of its nodes."""
    none = F.lit(None)
    tops = paths.select("group", F.col("index").alias("block"), F.lit(-1).cast("bigint").alias("index"), none.cast("bigint").alias("n"),
                        F.col("subroot").alias("digest"), "above", *[none.cast(nodes.schema[c].dataType).alias(c) for c in carried])
    own = nodes.select("group", F.expr(f"index div {BLOCK}").alias("block"), "index", "n", "digest", none.cast("binary").alias("above"), *carried)
    return _dealt(own.union(tops), "index")


def _descended(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The path of every node of a round, from the paths of the round above."""
    def sweep(batches):
        def rows():
            for top, *block in _blocks(batches):
                _, runs = forward([row[4].encode() for row in block], depth(block[0][3]))
                for row, path in zip(block, backward(len(block), runs, _unpacked(top[5]))):
                    yield row[0], row[2], top[4], _packed(path)
        return _chunks(rows(), _PATHS)

    return map_batches(_with_above(nodes, paths), "group bigint, index bigint, subroot string, above binary", sweep)


@dataclass
class Manifest:
    """Written tables of nodes: ``sources`` by rounds for all sources, ``top`` for the tree over their subroots.

    The first of ``sources`` are the leaves: group (number of the source), index, n, digest, doc_id, candidate."""
    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None

    def paths(self) -> DataFrame:
        """Path of the top block of each source's leaves, of all sources' lowest blocks: group, index, subroot, above."""
        start = self.top[-1].select("group", "index", F.col("digest").alias("subroot"), F.lit(b"").alias("above"))
        for nodes in reversed(self.top[:-1]):
            start = settle(_descended(nodes, start), "merkle_paths")
        # a node of the top tree is the root of a source
        own = start.select(F.col("index").alias("group"), F.lit(0).cast("bigint").alias("index"), "above")
        subroots = self.sources[-1].select("group", F.col("digest").alias("subroot"))
        paths = settle(own.join(subroots, "group").select("group", "index", "subroot", "above"), "merkle_paths")
        for nodes in reversed(self.sources[1:-1]):
            paths = settle(_descended(nodes, paths), "merkle_paths")
        return paths

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root (of the candidate) and verified of every document."""
        leaves, root = self.sources[0], self.root
        kind = leaves.schema["doc_id"].dataType.simpleString()

        def sweep(batches):
            def rows():
                for top, *block in _blocks(batches):
                    _, runs = forward([row[4].encode() for row in block], depth(block[0][3]))
                    for row, path in zip(block, backward(len(block), runs, _unpacked(top[5]))):
                        folded = fold((row[7] or row[4]).encode(), path).decode()
                        yield row[6], row[4], top[4], root, proof(path).decode(), folded, folded == root

            strings = [pa.field(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
            return _chunks(rows(), pa.schema([pa.field("doc_id", id_type), *strings, pa.field("verified", pa.bool_())]))

        id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
        return map_batches(
            _with_above(leaves, self.paths(), "doc_id", "candidate"),
            f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", sweep)


def _placed(rows: DataFrame, by: list[Column], keys: list[str], label: str) -> DataFrame:
    """``rows`` in the order ``by`` over all tasks, with ``_index`` from 0 within ``keys`` and ``_n``, the rows of each."""
    task, place = F.shiftright("_id", _ROW_BITS), F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rows = settle(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("_task", task).withColumn("_place", place)
    mine = Window.partitionBy(*[F.col(f"_k_{k}") for k in keys])
    before = mine.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_task").alias("_t"))
                  .agg(F.count(F.lit(1)).alias("_c"), F.min("_place").alias("_first"))
                  .withColumn("_offset", F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first"))
                  .withColumn("_n", F.sum("_c").over(mine)).drop("_c", "_first"))
    same = F.col("_task") == F.col("_t")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (rows.join(settle(counts, f"{label}_offsets"), same)
                .withColumn("_index", F.col("_offset") + F.col("_place"))
                .drop("_id", "_task", "_place", "_t", "_offset", *[f"_k_{k}" for k in keys]))


def build(docs: DataFrame, candidate: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (columns ``FIELDS``; others are not part of it).

    ``candidate`` is a leaf to be tested in place of a document's own, null for none.
    """
    other = F.lit(None).cast("string") if candidate is None else candidate
    leaves = settle(docs.select("doc_id", "source", leaf_of().alias("digest"), other.alias("candidate"),
                                F.monotonically_increasing_id().alias("_salt")), "merkle_leaves")
    by = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_last(), F.col("digest").asc(), F.col("_salt").asc()]
    placed = settle(_placed(leaves, by, ["source"], "merkle_sorted").drop("_salt"), "merkle_placed")
    sources = _placed(placed.select("source").distinct().withColumn("_all", F.lit(0)), [F.col("source").asc_nulls_first()],
                      ["_all"], "merkle_sources")
    numbers = settle(sources.select(F.col("source").alias("_source"), F.col("_index").alias("group")), "merkle_source_numbers")
    nodes = settle(placed.join(numbers, F.col("source").eqNullSafe(F.col("_source")))
                         .select("group", F.col("_index").alias("index"), F.col("_n").alias("n"), "digest", "doc_id", "candidate"),
                   "merkle_nodes")
    tower = _tower(nodes)
    total = numbers.count()
    top = _tower(tower[-1].select(F.lit(0).cast("bigint").alias("group"), F.col("group").alias("index"),
                                  F.lit(total).cast("bigint").alias("n"), "digest"))
    first = top[-1].select("digest").head(1)
    return Manifest(tower, top, first[0]["digest"] if first else None)


def lowered_candidate(modulus: int = 5) -> Column:
    """The leaf of a text with A-Z in lower case where ``modulus`` divides the unsigned crc32 of the decimal doc_id."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == 0, leaf_of(text=lowered))


def manifest(docs: DataFrame) -> DataFrame:
    """Every document's leaf, subroot, root, proof and the root that it folds to when every fifth text is changed."""
    return build(docs, lowered_candidate()).proofs()
