"""Change streams whose partitions split and merge: the tree of partitions, and changes in the order of the table.

A partition hands its keys to its children, so all of a key's changes in a parent come before those in a child. The
*generation* of a partition, the length of the longest way from a root, grows along every key's way through the tree,
also through merges. Changes of a key are therefore in order by generation, commit time and sequence in the
transaction, even where commit times are equal or partitions were read late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialise


def partition_edges(records: DataFrame) -> DataFrame:
    """``token, parent, start_ts`` out of the nested child records; a child without named parents is that of its reader."""
    children = (records.select("partition_token", F.explode("ChangeRecord").alias("r"))
                       .select("partition_token", F.explode("r.child_partitions_record").alias("p"))
                       .select("partition_token", F.col("p.start_timestamp").alias("start_ts"), F.explode("p.child_partitions").alias("c")))
    named = F.when(F.size(F.coalesce("c.parent_partition_tokens", F.array().cast("array<string>"))) > 0, F.col("c.parent_partition_tokens"))
    parents = F.coalesce(named, F.array("partition_token"))
    return (children.select(F.col("c.token").alias("token"), F.explode(parents).alias("parent"), "start_ts")
                    .where("token is not null").groupBy("token", "parent").agg(F.min("start_ts").alias("start_ts")))


def generations(records: DataFrame) -> DataFrame:
    """``token, generation`` of every partition that was read or named; roots have generation 0.

    A round places the partitions all of whose parents have a place, so there are as many rounds as the tree is deep. Only
    tokens and edges move. A cycle, which no change stream has, is an error.
    """
    edges = materialise(partition_edges(records), "partition_edges")
    tokens = (records.select(F.col("partition_token").alias("token")).where("token is not null")
              .union(edges.select("token")).union(edges.select("parent").where("parent is not null")).distinct())
    placed = [materialise(tokens.join(edges, "token", "left_anti").select("token", F.lit(0).alias("generation")), "generation")]
    # what every waiting partition still needs: its parents, less those that have a place
    waiting = materialise(edges.where("parent is not null").select("token", "parent", F.lit(0).alias("least")), "waiting")
    while waiting.head(1):
        newest = placed[-1].select(F.col("token").alias("parent"), "generation")
        met = waiting.join(newest, "parent", "left")
        state = met.groupBy("token").agg(F.bool_and(F.col("generation").isNotNull()).alias("_ready"),
                                         F.max(F.greatest("least", F.coalesce(F.col("generation") + 1, F.lit(0)))).alias("_least"))
        state = materialise(state, "generation_state")
        ready = materialise(state.where("_ready").select("token", F.col("_least").alias("generation")), "generation")
        if not ready.head(1):
            raise ValueError("partitions are their own ancestors")
        placed.append(ready)
        still = met.where("generation is null").join(state.where(~F.col("_ready")), "token")
        waiting = materialise(still.select("token", "parent", F.col("_least").alias("least")), "waiting")
    found = placed[0]
    for more in placed[1:]:
        found = found.unionByName(more)
    return found


def data_changes(records: DataFrame) -> DataFrame:
    """One row for each data change, with its partition."""
    return (records.select("partition_token", F.explode("ChangeRecord").alias("r"))
                   .select("partition_token", F.explode("r.data_change_record").alias("c"))
                   .select("partition_token", "c.*"))


def ordered_changes(records: DataFrame) -> DataFrame:
    """Data changes with ``generation`` and ``position``, which orders those of one key."""
    placed = generations(records).select(F.col("token").alias("partition_token"), "generation")
    changes = data_changes(records).join(placed, "partition_token", "left").withColumn("generation", F.coalesce("generation", F.lit(0)))
    return changes.withColumn("position", F.struct("generation", "commit_ts", "record_sequence"))


def replay(records: DataFrame, key: list[str], deleted: Column | None = None) -> DataFrame:
    """The table after all changes: the last one of each key, without keys whose last change is a deletion.

    The last change is an aggregate that combines before the shuffle, so a key with very many changes costs one line a task.
    """
    changes = ordered_changes(records)
    rest = [c for c in changes.columns if c not in (*key, "position")]
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), "position").alias("_last")).select(*key, "_last.*")
    return last.where(~(F.col("mod_type") == "DELETE" if deleted is None else deleted))


def early_changes(records: DataFrame) -> DataFrame:
    """Changes of a partition before the time at which its parents handed over to it: none in a sound stream."""
    starts = partition_edges(records).groupBy("token").agg(F.max("start_ts").alias("start_ts"))
    return data_changes(records).join(starts, F.col("partition_token") == F.col("token")).where("commit_ts < start_ts").drop("token")
