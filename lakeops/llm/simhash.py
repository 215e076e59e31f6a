"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has one bit for each bit of the shingles' hashes: 1 where over half of the hashes
have it. Fingerprints link if they differ in ``radius`` bits or fewer.

Candidates come from covering masks: bit i gets a vector m(i) of radius + 1 bits, and for every
vector v but zero there is a mask that keeps the bits whose m(i) has an odd overlap with v. Any
``radius`` vectors leave some v orthogonal to all of them, so every pair within the radius agrees
under some mask, with certainty.

Inside the buckets no pairs are made. Every member that shares a bucket names the values near it
(its own, and those with a few of the bits flipped that the mask drops). Two members link if and
only if one of them is within ``radius // 2`` of some value and the other within the rest, so
members that name a value in common form a star around the smallest, which keeps them connected
and is linear in the members, however large the bucket.

Documents without words have fingerprint zero, linked like any other. Null texts have no words.
Equal fingerprints are one node, so thousands of copies cost one row. Rows with a null doc_id get
a fingerprint and no component. Repeated rows of one doc_id each come back.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import column, discard, map_batches, settle, slices, texts_as_bytes
from lakeops.llm.components import connected_components

BITS = 64
SEED = 42
#: Counters of shingles by hash; they only order shingles, so any number gives the same links.
COUNTERS = 1 << 20
#: Pairs of one hub that are compared together.
BLOCK = 128


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces; of all words if there are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    runs = zip(*(words[i:] for i in range(size)))
    return np.fromiter((digest(s, SEED) for s in map(b" ".join, runs)), np.uint64, len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority of each bit; 0 for no hashes. Counted in blocks, so that memory stays flat."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        block = hashes[start:start + (1 << 15)].astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit number."""
    def compute(batches):
        for batch in batches:
            for part in slices(batch):
                prints = [fingerprint(shingle_hashes(t.lower().split(), shingle)) for t in texts_as_bytes(part)]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                    names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), f"doc_id {kind}, fp bigint", compute)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask for each nonzero vector of radius + 1 bits; bit vectors are dealt in turn."""
    vectors = range(1, 1 << (radius + 1))
    owner = [1 + i % len(vectors) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (owner[i] & v).bit_count() % 2) for v in vectors]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _near(mask: int, reach: int) -> Column:
    """The values within ``reach`` flips of ``fp`` among the bits that the mask drops."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    flips = [sum(chosen) for n in range(reach + 1) for chosen in combinations(free, n)]
    return F.transform(F.array(*[F.lit(_signed(x)) for x in flips]), lambda x: x.bitwiseXOR(F.col("fp")))


def link_fingerprints(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges ``fp``, ``hub`` that connect exactly the fingerprints which links connect."""
    masks = covering_masks(radius)
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    shared = (keys.groupBy("t", "key").agg(F.min("fp").alias("_low"), F.max("fp").alias("_high"))
                  .where("_low != _high").select("t", "key"))
    members = settle(keys.join(shared, ["t", "key"]).select("t", "fp"), "members")
    few, more = radius // 2, radius - radius // 2

    def named(reach: int) -> DataFrame:
        near = F.when(F.lit(False), F.array(F.lit(0).cast("bigint")))
        for t, mask in enumerate(masks):
            near = near.when(F.col("t") == t, _near(mask, reach))
        return members.select("fp", F.explode(near).alias("value")).distinct()

    hubs = named(few).groupBy("value").agg(F.min("fp").alias("hub"))
    # the files of ``members`` say nothing about the size of what is named, so no side may be broadcast by it
    return named(more).hint("merge").join(hubs.hint("merge"), "value").where("fp != hub").select("fp", "hub").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row."""
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    first = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "first_ids")
    groups = connected_components(settle(link_fingerprints(first, radius), "edges"), "fp", "hub")
    smallest = (groups.join(first, groups["node"] == first["fp"])
                      .groupBy("component").agg(F.min("first_id").alias("component_id")))
    of_print = settle(
        first.join(groups.join(smallest, "component").select(F.col("node").alias("fp"), "component_id"),
                   "fp", "left")
             .select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "components")
    known = F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    return (prints.join(of_print, "fp")
                  .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), known))


def passage_prints(hashes: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of the whole text, and of each run of shingles that begins where a hash is a
    multiple of ``length``, so that an edit changes only the runs that it touches."""
    whole = [fingerprint(hashes)]
    starts = np.flatnonzero(hashes % np.uint64(length) == 0)
    if len(hashes) and (not len(starts) or starts[0]):
        starts = np.concatenate([[0], starts])
    if len(starts) < 2:
        return np.array(whole, np.uint64)
    stops = np.append(starts[1:], len(hashes))
    found = [np.array(whole, np.uint64)]
    for at in range(0, len(starts), 512):
        begin, end = starts[at:at + 512], stops[at:at + 512]
        block = hashes[begin[0]:end[-1]]
        if len(block) > 1 << 18:  # long runs, one by one
            found.append(np.array([fingerprint(hashes[b:e]) for b, e in zip(begin, end)], np.uint64))
            continue
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin - begin[0], axis=0, dtype=np.int32)
        found.append(np.packbits(2 * ones > (end - begin)[:, None], axis=1, bitorder="little").view("<u8").ravel())
    return np.concatenate(found)


def _sketches(docs: DataFrame, shingle: int, length: int, masks: list[int]) -> DataFrame:
    """doc_id, the sorted distinct shingle hashes of its text as bytes and their number, and a key of 64 bits
    for each passage under each mask."""
    kept = [np.uint64(m) for m in masks]

    def compute(batches):
        for batch in batches:
            for part in slices(batch):
                sets, sizes, keys, ends = [], [], [], [0]
                for text in texts_as_bytes(part):
                    hashes = shingle_hashes(text.lower().split(), shingle)
                    own = np.unique(hashes).astype("<u8")
                    sets.append(own.tobytes())
                    sizes.append(len(own))
                    prints = passage_prints(hashes, length)
                    keys.append(np.unique(np.concatenate([
                        ((prints & m) ^ np.uint64(t + 1)) * np.uint64(0x9E3779B97F4A7C15) for t, m in enumerate(kept)])))
                    ends.append(ends[-1] + len(keys[-1]))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(sizes, pa.int32()), pa.array(sets, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))],
                    names=["doc_id", "size", "set", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), f"doc_id {kind}, size int, set binary, passages array<bigint>", compute)


def _hashes_of(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, "<u8")


def common_to(left: np.ndarray, right: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if not len(left) or not len(right):
        return 0
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    return int((right[at] == left).sum())


def _verified(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``doc_id``, ``hub`` whose sets have at least ``similarity`` of their union in common.

    A set of each pair travels to its hub; those of a hub are dealt into blocks of about ``BLOCK``, and
    the hub's own set goes once to each block.
    """
    counts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = settle(pairs.join(counts, "hub").select(
        "hub", F.expr("pmod(xxhash64(doc_id), blocks)").cast("int").alias("block"), "doc_id"), "dealt_pairs")
    sets = sketches.select("doc_id", "set")
    members = dealt.join(sets, "doc_id").select("hub", "block", F.lit(1).alias("side"), "doc_id", "set")
    hubs = (dealt.select("hub", "block").distinct().join(sets.withColumnRenamed("doc_id", "hub"), "hub")
                 .select("hub", "block", F.lit(0).alias("side"), F.col("hub").alias("doc_id"), "set"))

    def compare(batches):
        own = np.empty(0, np.uint64)
        for batch in batches:
            kept = []
            for side, stored in zip(column(batch, "side").to_pylist(), column(batch, "set")):
                hashes = _hashes_of(stored.as_buffer())
                if side == 0:
                    own = hashes.copy()
                    kept.append(False)
                    continue
                both = common_to(hashes, own)
                kept.append(both >= similarity * (len(hashes) + len(own) - both))
            yield batch.select(["doc_id", "hub"]).filter(pa.array(kept, pa.bool_()))

    kind = pairs.schema["doc_id"].dataType.simpleString()
    gathered = hubs.union(members).repartition("hub", "block").sortWithinPartitions("hub", "block", "side")
    links = settle(map_batches(gathered, f"doc_id {kind}, hub {kind}", compare), "near_links")
    discard(dealt)
    return links


def _frequencies(sketches: DataFrame) -> np.ndarray:
    """How many documents have a shingle of each of ``COUNTERS`` ranges of hashes; summed in Spark."""
    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            hashes = _hashes_of(b"".join(column(batch, "set").to_pylist()))
            total += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        found = np.flatnonzero(total)
        for at in range(0, len(found), 1 << 16):
            some = found[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["counter", "n"])

    sums = (map_batches(sketches.select("set"), "counter int, n bigint", count)
            .groupBy("counter").agg(F.sum("n").alias("n")).toArrow())
    counters = np.zeros(COUNTERS, np.uint32)
    counters[sums["counter"].to_numpy()] = np.minimum(sums["n"].to_numpy(), (1 << 32) - 1)
    return counters


def prefix(hashes: np.ndarray, counters: np.ndarray, similarity: float) -> np.ndarray:
    """The first of the distinct hashes, rare ones first: one more than a set may lose and still be similar.

    Any one order of all hashes makes two similar sets meet in their prefixes; this one is by the
    counter of a hash, then by the hash.
    """
    wanted = len(hashes) - int(np.ceil(similarity * len(hashes) - 1e-9)) + 1
    return hashes[np.lexsort((hashes, counters[hashes % np.uint64(len(counters))]))[:wanted]]


def _prefix_keys(sketches: DataFrame, similarity: float) -> DataFrame:
    """doc_id, number of shingles, and place and hash of those in its prefix."""
    sent = sketches.sparkSession.sparkContext.broadcast(_frequencies(sketches))

    def compute(batches):
        for batch in batches:
            keys = [np.empty(0, np.uint64)]
            keys += [prefix(_hashes_of(stored.as_buffer()), sent.value, similarity) for stored in column(batch, "set")]
            counts = np.array([len(k) for k in keys[1:]], np.int64)
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(rows), column(batch, "size").take(rows),
                 pa.array(places.astype(np.int32)), pa.array(np.concatenate(keys).view(np.int64))],
                names=["doc_id", "size", "place", "key"])

    kind = sketches.schema["doc_id"].dataType.simpleString()
    return map_batches(sketches.select("doc_id", "size", "set"), f"doc_id {kind}, size int, place int, key bigint", compute)


def _prefix_buckets(sketches: DataFrame, similarity: float) -> DataFrame:
    """doc_id, size, place and key of the shingles in prefixes that several documents have there."""
    keys = settle(_prefix_keys(sketches, similarity), "prefix_keys")
    shared = settle(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "shared_keys")
    buckets = settle(keys.join(shared, "key", "left_semi"), "prefix_buckets")
    discard(keys, shared)
    return buckets


def _unlinked(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """The members, with their ``group``, of buckets that ``links`` do not connect."""
    groups = connected_components(links, "doc_id", "hub").select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    members = settle(buckets.join(groups, "doc_id", "left").withColumn("group", F.coalesce("group", "doc_id")), "members")
    apart = members.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low != high")
    apart = settle(apart.select("key"), "apart")
    unlinked = settle(members.join(apart, "key", "left_semi"), "unlinked")
    discard(members, apart)
    return unlinked


def _possible(similarity: float) -> Column:
    """Whether a member and another that first meet at these places can be similar and are not linked yet."""
    shared = F.least(F.col("size") - F.col("place"), F.col("o_size") - F.col("o_place"))
    return ((F.col("group") != F.col("o_group"))
            & (F.least("size", "o_size") >= F.greatest("size", "o_size") * similarity - 1e-6)
            & (shared >= (F.col("size") + F.col("o_size")) * (similarity / (1 + similarity)) - 1e-6))


def _remaining_links(sketches: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Links that, with ``links``, connect all that similar pairs connect.

    Similar documents share a shingle of their prefixes. In each bucket, the members first meet the one
    with the fewest rarer shingles. Buckets that are connected after that need no more; in all others
    every two members that no links connect are compared, if their lengths and places allow it.
    """
    buckets = _prefix_buckets(sketches, similarity)
    members = _unlinked(buckets, links)
    hubs = settle(members.groupBy("key").agg(F.min(F.struct(
        (F.col("place") / F.col("size")).alias("at"), F.col("doc_id").alias("hub"), F.col("size").alias("o_size"),
        F.col("place").alias("o_place"), F.col("group").alias("o_group"))).alias("first")).select("key", "first.*"), "hubs")
    near = settle(members.join(hubs, "key").where(_possible(similarity)).select("doc_id", "hub").distinct(), "near_pairs")
    found = _verified(near, sketches, similarity)
    discard(members, hubs)
    members = _unlinked(buckets, links.union(found))
    others = members.select("key", F.col("doc_id").alias("hub"), F.col("size").alias("o_size"),
                            F.col("place").alias("o_place"), F.col("group").alias("o_group"))
    met = near.union(near.select(F.col("hub").alias("doc_id"), F.col("doc_id").alias("hub")))
    rest = settle(members.join(others.hint("merge"), "key").where(F.col("doc_id") < F.col("hub")).where(_possible(similarity))
                         .select("doc_id", "hub").distinct().join(met, ["doc_id", "hub"], "left_anti"), "rest_pairs")
    discard(buckets, members, near)
    more = _verified(rest, sketches, similarity)
    discard(rest)
    return found.union(more)


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, length: int = 32,
                         radius: int = 1) -> DataFrame:
    """``docs`` without the documents whose group of near-duplicates has a smaller doc_id.

    Near-duplicates share ``similarity`` of their distinct word shingles. A SimHash of a whole text
    moves by a tenth of its bits at that similarity, far beyond any radius that covering masks can
    serve, so the texts' passages have fingerprints too: of the passages of two near-duplicates
    most are equal. Under each mask, documents with a passage in common are held against the first
    and the last of them, whatever their number, and every link is verified on the whole sets of
    shingles. What that leaves apart meets in prefixes. Texts are hashed once, into ``sketches``, which
    all steps read. Equal texts count as one document first. Rows with a null doc_id stay; rows that
    repeat a doc_id stand or fall together.
    """
    known = docs.where("doc_id is not null").select("doc_id", "text")
    same = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("same")
    hashed = settle(known.select("doc_id", same), "text_hashes")
    firsts = settle(hashed.groupBy("same").agg(F.min("doc_id").alias("first_id")), "first_texts")
    copies = settle(hashed.join(firsts, "same").where("doc_id != first_id")
                          .select("doc_id", F.col("first_id").alias("hub")), "copies")
    repeated = hashed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1)
    made = _sketches(known.join(copies.select("doc_id"), "doc_id", "left_anti"), shingle, length, covering_masks(radius))
    sketches = settle(made.dropDuplicates(["doc_id"]) if repeated else made, "sketches")
    discard(hashed, firsts)
    keys = sketches.select("doc_id", "size", F.explode("passages").alias("key"))
    ends = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low != high")
    met = (keys.join(ends, "key").select("doc_id", "size", F.explode(F.array("low", "high")).alias("hub"))
               .where("doc_id != hub").distinct())
    sizes = sketches.select(F.col("doc_id").alias("hub"), F.col("size").alias("hub_size"))
    pairs = settle(met.join(sizes, "hub")
                      .where(F.least("size", "hub_size") >= F.greatest("size", "hub_size") * similarity - 1e-6)
                      .select("doc_id", "hub"), "passage_pairs")
    links = settle(_verified(pairs, sketches, similarity).union(copies), "links_so_far")
    discard(pairs)
    links = links.union(_remaining_links(sketches, links, similarity))
    groups = connected_components(links, "doc_id", "hub")
    gone = settle(groups.where("node != component").select(F.col("node").alias("doc_id")), "near_duplicates")
    discard(sketches, copies)
    return docs.join(gone, "doc_id", "left_anti")
