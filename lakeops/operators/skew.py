"""Group-wise work that stays whole and parallel when one key holds a third of all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.session import materialise

# Spark fills the low 33 bits of monotonically_increasing_id with the row's place in its task.
_ROW_BITS = 33


def nest_groups(df: DataFrame, keys: list[str], items: list[str], order: list[str],
                name: str, max_items: int = 100_000) -> DataFrame:
    """One row per key with ``items`` nested in order, as ``name``.

    A key with more than ``max_items`` entries comes back as several rows with consecutive
    ``part`` numbers: joined in that order, the parts are the one list, whatever the bound.
    Counts are gathered first, which combines map-side; in the usual case no key is long, and
    the rows are then shuffled once and joined with nothing. Null keys are keys like others.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    long_keys = materialise(
        counts.where(F.col("_n") > max_items).select(*[F.col(k).alias(f"_l_{k}") for k in keys]), "long_keys")
    if long_keys.head(1):
        same = _same(df, long_keys, keys, "_l_")
        rows = df.join(long_keys, same, "left_anti").withColumn("part", F.lit(0)).unionByName(
            _consecutive_parts(df.join(long_keys, same, "left_semi"), keys, order, items, max_items))
    else:
        rows = df.withColumn("part", F.lit(0))
    entry = F.struct(*[F.col(c) for c in order + [i for i in items if i not in order]])
    grouped = rows.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    shaped = F.transform("_list", lambda e: F.struct(*[e.getField(i).alias(i) for i in items]))
    return grouped.select(*keys, "part", shaped.alias(name))


def _consecutive_parts(df: DataFrame, keys: list[str], order: list[str], items: list[str], size: int) -> DataFrame:
    """Rows with the ``part`` that their place in their key's order falls into.

    The rows are sorted over all tasks, copies told apart by a written-down salt, and written
    with their place inside their task; one count per key and task gives the offsets.
    """
    salted = materialise(df.withColumn("_salt", F.monotonically_increasing_id()), "salted")
    by = [F.col(c) for c in [*keys, *order, *[i for i in items if i not in order]]] + [F.xxhash64("_salt")]
    placed = materialise(salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
                               .withColumn("_id", F.monotonically_increasing_id()), "placed")
    task, place = F.shiftright("_id", _ROW_BITS), F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = placed.withColumn("_task", task).withColumn("_place", place)
    before = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
                     .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
                     .select(*[F.col(c).alias(f"_o_{c}") for c in [*keys, "_task"]], "_offset"))
    return (placed.join(offsets, _same(placed, offsets, [*keys, "_task"], "_o_"))
                  .withColumn("part", F.floor((F.col("_offset") + F.col("_place")) / size).cast("int"))
                  .select(*df.columns, "part"))


def join_small(df: DataFrame, side: DataFrame, keys: list[str], how: str = "inner",
               max_rows: int = 100_000) -> DataFrame:
    """Join a side that is written down and usually small: broadcast up to ``max_rows`` rows,
    an ordinary join, which the adaptive planner may still split or convert, beyond."""
    return df.join(F.broadcast(side) if side.count() <= max_rows else side, keys, how)


def newest_within_budget(df: DataFrame, keys: list[str], position: str, cost: Column,
                         budget: int, block: int = 4096) -> DataFrame:
    """Rows of each key whose cost, summed from the newest position down, fits the budget.

    Rows of one position count together. Costs are added up per position first, which
    combines map-side; the totals of fixed blocks of positions are accumulated next, blocks
    that start beyond the budget are dropped there, and the rest is summed inside one block
    at a time. Whole rows move once, to meet the positions that fit.
    """
    places, blocks = [*keys, position], [*keys, "_block"]
    costs = (df.groupBy(*places).agg(F.sum(cost).alias("_cost"))
               .withColumn("_block", F.floor(F.col(position) / block)))
    newer_blocks = (Window.partitionBy(*keys).orderBy(F.desc("_block"))
                          .rowsBetween(Window.unboundedPreceding, -1))
    reachable = (costs.groupBy(*blocks).agg(F.sum("_cost").alias("_total"))
                      .withColumn("_newer", F.coalesce(F.sum("_total").over(newer_blocks), F.lit(0)))
                      .where(F.col("_newer") <= budget)
                      .select(*[F.col(c).alias(f"_r_{c}") for c in blocks], "_newer"))
    inside = Window.partitionBy(*blocks).orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, 0)
    fitting = (costs.join(reachable, _same(costs, reachable, blocks, "_r_"))
                    .withColumn("_used", F.col("_newer") + F.sum("_cost").over(inside))
                    .where(F.col("_used") <= budget)
                    .select(*[F.col(c).alias(f"_f_{c}") for c in places]))
    return df.join(fitting, _same(df, fitting, places, "_f_"), "left_semi")


def _same(left: DataFrame, right: DataFrame, columns: list[str], prefix: str) -> Column:
    """Equality of columns with their prefixed twins; null equals null, as in a group."""
    return reduce(and_, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in columns])


def number_rows(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """A gap-free 0-based row number over a total order, without a one-task window.

    The range-sorted rows are written once with their place inside their task; the offsets
    come from one count per task.
    """
    placed = materialise(
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_id", _ROW_BITS)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # one line per task of the sort above, never one per row
    offsets = materialise(
        placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .drop("_n"), "offsets")
    place = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (join_small(placed.withColumn("_task", task), offsets, ["_task"])
            .withColumn(name, F.col("_offset") + place)
            .drop("_task", "_id", "_offset"))


def rank_evenly(df: DataFrame, columns: list[str]) -> DataFrame:
    """Range-partition and sort by ``columns``; equal values may still spread over tasks.

    The rows are written down once with a salt, which tells equal rows apart; the sample of the range partitioning
    and the sort read that. The input is evaluated once.
    """
    salted = materialise(df.withColumn("_salt", F.monotonically_increasing_id()), "salted")
    return (salted.repartitionByRange(*[F.col(c) for c in columns], F.xxhash64("_salt")).drop("_salt")
                  .sortWithinPartitions(*columns))


def cluster_evenly(df: DataFrame, columns: list[str], within: list[str] = (), bits: int = 4) -> DataFrame:
    """Range-partition so that a filter on any one of ``columns`` reads a small part of the files.

    Each column's values get ranks of ``bits`` bits from its quantiles, which one aggregate sketches for all columns, and
    the layout key takes a bit of each column in turn, the highest first. Equal and very frequent values share a
    rank and are dealt by a salt. ``within`` comes before: files hold ranges of it first. With one
    column this is ``rank_evenly``.
    """
    if len(columns) == 1:
        return rank_evenly(df, [*within, *columns])
    salted = materialise(df.withColumn("_salt", F.monotonically_increasing_id()), "salted")
    numbers = {c: _ordered_number(salted, c) for c in columns}
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = salted.agg(*[F.percentile_approx(n, steps, 1_000).alias(f"_q{i}") for i, n in enumerate(numbers.values())]).first()
    key = F.lit(0).cast("bigint")
    for i, number in enumerate(numbers.values()):
        # a rank's bits, spread to the places that the column has in the key
        spread = [sum((rank >> bit & 1) << (bit * len(columns) + len(columns) - 1 - i) for bit in range(bits)) for rank in range(1 << bits)]
        key = key.bitwiseOR(_rank(number, sorted(set(cuts[f"_q{i}"] or [])), spread))
    placed = salted.withColumn("_key", key)
    order = [*[F.col(c) for c in within], F.col("_key")]
    return (placed.repartitionByRange(*order, F.xxhash64("_salt")).sortWithinPartitions(*order, *columns).drop("_salt", "_key"))


def _ordered_number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column; of a text its first seven bytes."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    return column.cast("double") if isinstance(kind, (T.FractionalType, T.DecimalType)) else column.cast("bigint")


def _rank(number: Column, cuts: list, values: list[int]) -> Column:
    """``values`` by how many cuts are below a number, found by halving; null comes first."""
    def find(low: int, high: int) -> Column:
        if low == high:
            return F.lit(values[low]).cast("bigint")
        middle = (low + high) // 2
        return F.when(number > F.lit(cuts[middle]), find(middle + 1, high)).otherwise(find(low, middle))

    return F.when(number.isNull(), F.lit(values[0]).cast("bigint")).otherwise(find(0, len(cuts)))
