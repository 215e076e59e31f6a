"""Sharding by best-fit-decreasing bin packing.

Equal texts form a group that stays together. Groups enter, largest first, the shard whose remaining
capacity is the tightest that still takes them; the shards lie in a balanced tree by remaining
capacity. The capacity is the smallest one, up to one part in ``FINENESS``, for which the packing
needs no more than the wanted number of shards, which keeps their sizes near equal.

Then the fullest and the emptiest shard exchange items while that brings them nearer.

A group of at least one ``HEAVY``-th of a shard is an item of its own; there are at most ``HEAVY``
times as many of them as shards, whatever the input. Lighter groups are classed by size, ``STEPS``
classes for each doubling, and the groups of a class are dealt in turn into runs, which are items:
as many runs as its share of ``RUNS`` for each shard, rounded up, so groups of one size get equal
runs. The driver packs a list that grows with the number of shards and of classes only, while every
group, in whatever number, gets its shard by a join with it. A group that is larger than a shard's
fair part cannot stay whole if sizes are to be near equal; such groups, fewer than there are shards,
are split by a hash of the row's id.

Null texts have no bytes and form one group. Repeated rows each get a place. ``slot`` numbers the
rows of a shard without gaps.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import with_rank
from lakeops.session import materialise

SHARDS = 40
#: Bytes that each row takes besides its text.
ROW_BYTES = 16
HEAVY = 1_000
RUNS = 100
STEPS = 64
FINENESS = 10_000


class CapacityTree:
    """(remaining, bin) pairs in order: a tree of two levels whose leaves are split when they grow long."""

    LEAF = 256

    def __init__(self) -> None:
        self.leaves: list[list[tuple[int, int]]] = []
        self.tops: list[tuple[int, int]] = []

    def insert(self, pair: tuple[int, int]) -> None:
        if not self.leaves:
            self.leaves, self.tops = [[pair]], [pair]
            return
        at = min(bisect_left(self.tops, pair), len(self.leaves) - 1)
        leaf = self.leaves[at]
        insort(leaf, pair)
        self.tops[at] = leaf[-1]
        if len(leaf) > self.LEAF:
            half = len(leaf) // 2
            self.leaves[at:at + 1] = [leaf[:half], leaf[half:]]
            self.tops[at:at + 1] = [leaf[half - 1], leaf[-1]]

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least remaining capacity that holds ``size``."""
        at = bisect_left(self.tops, (size, -1))
        if at == len(self.leaves):
            return None
        leaf = self.leaves[at]
        pair = leaf.pop(bisect_left(leaf, (size, -1)))
        if leaf:
            self.tops[at] = leaf[-1]
        else:
            del self.leaves[at], self.tops[at]
        return pair


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item, sizes being in falling order; None if more than ``most`` bins are needed."""
    tree, bins, chosen = CapacityTree(), 0, []
    for size in sizes:
        pair = tree.take_tightest(size)
        if pair is None:
            if bins == most or size > capacity:
                return None
            pair, bins = (capacity, bins), bins + 1
        chosen.append(pair[1])
        tree.insert((pair[0] - size, pair[1]))
    return chosen


def pack_evenly(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item (sizes in falling order) at about the smallest capacity that suffices, levelled.

    An item of a fair part or more fills a shard alone; the others share the remaining shards.
    """
    total, alone = sum(sizes), 0
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) >= total:
        total -= sizes[alone]
        alone += 1
    rest = sizes[alone:]
    return [*range(alone), *(alone + home for home in level(rest, _pack(rest, shards - alone), shards - alone))]


def _exchange(full: list[tuple[int, int]], empty: list[tuple[int, int]], gap: int) -> tuple | None:
    """The item of ``full`` to move, and the one of ``empty`` to get for it (or None), that bring the two nearest."""
    best, found = gap, None
    for n, (size, _) in enumerate(full):
        if n and size == full[n - 1][0]:
            continue
        if size < gap and abs(gap - 2 * size) < best:
            best, found = abs(gap - 2 * size), (n, None)
        at = bisect_left(empty, (size - gap / 2, -1))
        for m in (at - 1, at):
            if 0 <= m < len(empty) and abs(gap - 2 * (size - empty[m][0])) < best:
                best, found = abs(gap - 2 * (size - empty[m][0])), (n, m)
        if best <= 1:
            break
    return found


def level(sizes: list[int], homes: list[int], shards: int) -> list[int]:
    """``homes`` after exchanges between the fullest and the emptiest shard, until none brings those nearer.

    Each exchange lowers the sum of the squared loads, so they end."""
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for item, (size, home) in enumerate(zip(sizes, homes)):
        held[home].append((size, item))
    loads = sorted((sum(size for size, _ in items), home) for home, items in enumerate(held))
    for items in held:
        items.sort()
    while len(loads) > 1:
        (least, low), (most, high) = loads[0], loads[-1]
        found = _exchange(held[high], held[low], most - least)
        if found is None:
            break
        moved = held[high].pop(found[0])
        got = held[low].pop(found[1]) if found[1] is not None else None
        insort(held[low], moved)
        if got:
            insort(held[high], got)
        change = moved[0] - (got[0] if got else 0)
        loads = loads[1:-1]
        insort(loads, (least + change, low))
        insort(loads, (most - change, high))
    chosen = [0] * len(sizes)
    for home, items in enumerate(held):
        for _, item in items:
            chosen[item] = home
    return chosen


def _pack(sizes: list[int], shards: int) -> list[int]:
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // shards))
    best = best_fit_decreasing(sizes, low, shards)
    if best is not None:
        return best
    high = low
    while best is None:
        high += high
        best = best_fit_decreasing(sizes, high, shards)
    while high - low > max(1, low // FINENESS):
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, shards)
        if found is None:
            low = middle
        else:
            high, best = middle, found
    return best


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document; sizes of shards near equal."""
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.xxhash64("text").alias("_group"))
    rows = materialise(rows, "sized")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    fair = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // shards))
    large = groups.where(F.col("_bytes") > fair).collect()  # fewer than there are shards
    part = F.lit(0)
    for group in large:
        pieces = F.lit(-(-HEAVY * group["_bytes"] // (fair * 100)))
        part = F.when(F.col("_group") == group["_group"],
                      F.pmod(F.xxhash64("doc_id", F.lit(1)), pieces)).otherwise(part)
    rows = rows.withColumn("_part", part.cast("int"))
    items = rows.groupBy("_group", "_part").agg(F.sum("size").alias("_bytes"))
    heavy = items.where(F.col("_bytes") * HEAVY >= fair).collect()  # at most HEAVY for each shard
    known = spark.createDataFrame([(r["_group"], r["_part"], i) for i, r in enumerate(heavy)],
                                  "_group bigint, _part int, _heavy int")
    rows = materialise(rows.join(F.broadcast(known), ["_group", "_part"], "left"), "grouped")
    light = (rows.where("_heavy is null").groupBy("_group", "_part").agg(F.sum("size").alias("_bytes"))
                 .withColumn("_class", F.floor(F.log2("_bytes") * STEPS).cast("int")))
    ranked = materialise(with_rank(light, "_class", "_rank", "light_groups"), "ranked_groups")
    classes = ranked.groupBy("_class").agg(F.sum("_bytes").alias("_all")).collect()  # STEPS for each doubling
    total = sum(r["_all"] for r in classes)
    runs = spark.createDataFrame([(r["_class"], shards * -(-RUNS * r["_all"] // total)) for r in classes], "_class int, _runs bigint")
    dealt = materialise(ranked.join(F.broadcast(runs), "_class").withColumn("_run", F.col("_rank") % F.col("_runs")), "dealt_groups")
    found = dealt.groupBy("_class", "_run").agg(F.sum("_bytes").alias("_bytes")).collect()
    entries = sorted([(r["_bytes"], -1, i) for i, r in enumerate(heavy)]
                     + [(r["_bytes"], r["_class"], r["_run"]) for r in found], key=lambda e: (-e[0], e[1:]))
    homes = pack_evenly([e[0] for e in entries], shards)
    placed = spark.createDataFrame([(*e[1:], home) for e, home in zip(entries, homes)], "_class int, _run bigint, shard int")
    own = (rows.where("_heavy is not null").withColumn("_class", F.lit(-1)).withColumn("_run", F.col("_heavy").cast("bigint"))
               .select("doc_id", "size", "text_crc32", "_class", "_run"))
    others = (rows.where("_heavy is null").join(dealt.select("_group", "_part", "_class", "_run"),
                                                (rows["_group"].eqNullSafe(dealt["_group"])) & (rows["_part"] == dealt["_part"]))
                  .select("doc_id", "size", "text_crc32", "_class", "_run"))
    rows = own.unionByName(others).join(F.broadcast(placed), ["_class", "_run"]).select("doc_id", "size", "text_crc32", "shard")
    return with_rank(rows, "shard", "slot", "slots")
