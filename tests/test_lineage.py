"""Change streams with splits and merges, against a replay row by row."""

import datetime as dt
import random

import pytest

from lakeops.streaming.lineage import early_changes, generations, ordered_changes, replay

SCHEMA = """partition_token string, ChangeRecord array<struct<
  data_change_record: array<struct<commit_ts: timestamp, record_sequence: string, mod_type: string, key: int, value: int>>,
  child_partitions_record: array<struct<start_timestamp: timestamp, record_sequence: string,
    child_partitions: array<struct<token: string, parent_partition_tokens: array<string>>>>>>>"""
START = dt.datetime(2024, 1, 1)


def stream(seed, keys=24, steps=60):
    """Partitions that own keys and split or merge at random; commit times move on every few changes only."""
    rng = random.Random(seed)
    owned, table, log = {"root": set(range(keys))}, {}, []
    made, clock, depth = 0, 0, {"root": 0}
    for _ in range(steps):
        kind = rng.random()
        if kind < 0.15 and any(len(v) > 1 for v in owned.values()):
            parent = rng.choice([t for t, v in owned.items() if len(v) > 1])
            mine, kept = sorted(owned.pop(parent)), []
            cut = rng.randrange(1, len(mine))
            children = [f"p{made}", f"p{made + 1}"]
            made += 2
            owned[children[0]], owned[children[1]] = set(mine[:cut]), set(mine[cut:])
            kept = [(c, [parent]) for c in children]
            depth.update({c: depth[parent] + 1 for c in children})
            log.append((parent, None, (clock, kept)))
        elif kind < 0.25 and len(owned) > 1:
            parents = rng.sample(sorted(owned), 2)
            child = f"p{made}"
            made += 1
            owned[child] = owned.pop(parents[0]) | owned.pop(parents[1])
            depth[child] = 1 + max(depth[p] for p in parents)
            for p in parents:  # either parent reports the merged child
                log.append((p, None, (clock, [(child, parents)])))
        else:
            clock += rng.random() < 0.3
            token = rng.choice([t for t, v in owned.items() if v])
            key, value = rng.choice(sorted(owned[token])), rng.randrange(1000)
            delete = rng.random() < 0.2
            log.append((token, (clock, len(log), "DELETE" if delete else "UPDATE", key, value), None))
            table[key] = None if delete else value
    return log, {k: v for k, v in table.items() if v is not None}, depth


def frame(spark, log):
    def row(token, change, children):
        at = lambda c: START + dt.timedelta(seconds=int(c))
        data = [(at(change[0]), f"{change[1]:08d}", *change[2:])] if change else []
        parts = [(at(children[0]), "0", children[1])] if children else []
        return token, [(data, parts)]
    rows = [row(*x) for x in log]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_is_the_table(spark, seed):
    log, table, depth = stream(seed)
    records = frame(spark, log)
    assert len(depth) > 5
    assert {r["token"]: r["generation"] for r in generations(records).collect()} == depth
    assert {r["key"]: r["value"] for r in replay(records, ["key"]).collect()} == table
    order = [r["record_sequence"] for r in ordered_changes(records).orderBy("key", "position").collect()]
    expected = [f"{c[1]:08d}" for key in range(24) for _, c, _ in log if c and c[3] == key]
    assert order == expected and early_changes(records).count() == 0


def test_odd_streams(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert generations(none).count() == 0 and replay(none, ["key"]).count() == 0
    cycle = frame(spark, [("a", None, (0, [("b", ["a"])])), ("b", None, (0, [("a", ["b"])]))])
    with pytest.raises(ValueError):
        generations(cycle)
    late = frame(spark, [("a", None, (5, [("b", [])])), ("b", (3, 1, "UPDATE", 1, 1), None)])
    assert [r["key"] for r in early_changes(late).collect()] == [1]
    assert {r["token"]: r["generation"] for r in generations(late).collect()} == {"a": 0, "b": 1}
