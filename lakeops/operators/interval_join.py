"""Joins on overlapping intervals without a nested loop.

Bins of width ``STEP ** level`` cover the axis at each level. An interval belongs to the lowest level whose bins are at
least as long as it is, and so touches two bins there at most, however long it is. Of two intervals that overlap, the
one of the higher level meets the other in the bins of its own level: each side is looked up at its own level and at
the levels above it that the other side has. A pair is kept in one bin only, the one that holds the later of the two
starts. Bins are equality keys, so the join is a sort-merge join. It is never a broadcast: Spark judges a side by its size
before it is spread over bins or cells, which may make a hundred rows of one.

A bin in which very many rows of the left side start is split: its left rows are dealt over parts, and the right
rows go to each part.

Sums over the pairs of groups of rows need no pairs. Of two intervals that overlap, the later start lies in the other
interval. An interval is cut into the largest cells of width ``CUT ** level`` that tile it, a few for each level, and a
start lies in one cell of each level. Both sides are added up by cell, and the cells are equality keys, so the work grows
with the rows, however many pairs there are; rows at one instant are combined inside tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.skew import join_small
from lakeops.session import materialise

STEP = 8
#: Rows of the left side in one bin from which on it is split, and about the rows of a part.
HOT = 50_000
#: Each level's cells are this many times as wide as those of the level below.
CUT = 4


def _number(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    raise TypeError(f"intervals are of integers, dates or timestamps, not {kind.simpleString()}")


def _binned(df: DataFrame, start: str, end: str, side: str) -> DataFrame:
    """Rows as structs, with whole-number bounds (both inside) and the level of the interval."""
    low, high = _number(F.col(start), df.schema[start].dataType), _number(F.col(end), df.schema[end].dataType)
    length = F.greatest(F.lit(1), F.col("high") - F.col("low") + 1)
    level = F.ceil(F.log(float(STEP), length.cast("double")) - 1e-12).cast("int")
    # a length just above a power may round down
    level = F.when(F.pow(F.lit(float(STEP)), level) < length, level + 1).otherwise(level)
    return (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side), low.alias("low"), (high - 1).alias("high"))
              .where("low is not null and high is not null and low <= high").withColumn("level", level))


def _spread(rows: DataFrame, levels: list[int], side: str) -> DataFrame:
    """Each row in its bins at the given levels from its own up; ``_own`` tells which is its own."""
    wanted = F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x >= F.col("level"))
    width = F.pow(F.lit(float(STEP)), F.col("_level")).cast("bigint")
    # whole-number division: doubles do not hold microseconds exactly
    first, last = (F.expr(f"({c} - pmod({c}, _width)) div _width") for c in ("low", "high"))
    return (rows.withColumn("_level", F.explode(wanted)).withColumn("_width", width)
                .withColumn("_bin", F.explode(F.sequence(first, last)))
                .select(side, F.col("low").alias(f"{side}_low"), F.col("high").alias(f"{side}_high"),
                        (F.col("level") == F.col("_level")).alias(f"{side}_own"), "_level", "_bin", "_width"))


def interval_join(left: DataFrame, right: DataFrame, left_interval: tuple[str, str], right_interval: tuple[str, str],
                  on: list[str] = (), per: tuple[list[str], list[str]] | None = None, count: str = "n",
                  sums: dict[str, str] | None = None) -> DataFrame:
    """Pairs of rows whose half-open intervals ``[start, end)`` overlap, as structs ``left`` and ``right``.

    ``on`` names columns that must be equal as well. Null bounds and empty intervals overlap nothing; for a point, give an
    interval of one unit. Every overlapping pair comes once.

    With ``per``, columns of the left and of the right side, the pairs are grouped by these: one row for each group with
    a pair, with the number of pairs as ``count`` and, for each name in ``sums``, the sum over the pairs of a whole-number
    column ``left.x`` or ``right.x``. No pair is made then.
    """
    if per is not None:
        return _sums_of_pairs(left, right, left_interval, right_interval, on, per, count, sums or {})
    l_rows, r_rows = _binned(left, *left_interval, "left"), _binned(right, *right_interval, "right")
    levels = sorted({r[0] for df in (l_rows, r_rows) for r in df.select("level").distinct().collect()})  # at most 22
    if not levels:
        return l_rows.select("left").join(r_rows.select("right"), F.lit(False)).limit(0)
    keys = ["_level", "_bin", *[f"_on{i}" for i in range(len(on))]]

    def keyed(rows: DataFrame, side: str) -> DataFrame:
        spread = _spread(rows, levels, side)
        for i, name in enumerate(on):
            spread = spread.withColumn(f"_on{i}", F.col(f"{side}.{name}"))
        return spread

    l_spread, r_spread = keyed(l_rows, "left"), keyed(r_rows, "right").drop("_width")
    hot = materialise(l_spread.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
                              .select(*keys, F.ceil(F.col("n") / HOT).cast("int").alias("_parts")), "hot_bins")
    if hot.head(1):
        l_spread = (join_small(l_spread, hot, keys, "left")
                    .withColumn("_part", F.floor(F.rand(seed=1) * F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts"))
        l_spread = materialise(l_spread, "dealt")  # a repeated task must deal its rows the same way
        r_spread = (join_small(r_spread, hot, keys, "left")
                    .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts"))
        keys = [*keys, "_part"]
    start = F.greatest("left_low", "right_low")
    met = l_spread.join(r_spread.hint("merge"), keys).where(
        (F.col("left_own") | F.col("right_own")) & (F.col("left_low") <= F.col("right_high")) & (F.col("right_low") <= F.col("left_high"))
        & ((start - F.pmod(start, F.col("_width"))) == F.col("_bin") * F.col("_width")))
    return met.select("left", "right")


def _cells(first: Column, beyond: Column, top: int) -> Column:
    """The largest cells (level, cell) that tile the whole numbers from ``first`` to before ``beyond``."""
    def tiled(level: int) -> Column:
        width, wider = CUT ** level, CUT ** (level + 1)
        start, stop = -_floor(-first, width), _floor(beyond, width)
        inner, outer = -_floor(-first, wider) * CUT, _floor(beyond, wider) * CUT  # cells of the next level, in this one's
        none = F.array().cast("array<bigint>")
        def numbers(a: Column, b: Column) -> Column:
            return F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
        parts = numbers(start, stop) if level == top else F.when(
            inner < outer, F.concat(numbers(start, inner), numbers(outer, stop))).otherwise(numbers(start, stop))
        return F.transform(parts, lambda cell: F.struct(F.lit(level).alias("level"), cell.alias("cell")))

    return F.flatten(F.array(*[tiled(level) for level in range(top + 1)]))


def _floor(number: Column, width: int) -> Column:
    """Whole-number division, rounding down: doubles do not hold microseconds exactly."""
    return F.call_function("div", number - F.pmod(number, F.lit(width).cast("bigint")), F.lit(width).cast("bigint"))


def _sums_of_pairs(left: DataFrame, right: DataFrame, left_interval: tuple[str, str], right_interval: tuple[str, str],
                   on: list[str], per: tuple[list[str], list[str]], count: str, sums: dict[str, str]) -> DataFrame:
    wanted = {name: column.split(".", 1) for name, column in sums.items()}
    for name, (side, column) in wanted.items():
        kind = (left if side == "left" else right).schema[column].dataType
        if not isinstance(kind, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"{name} is not the sum of a whole-number column, but of {kind.simpleString()}")
    l_rows, r_rows = _binned(left, *left_interval, "left"), _binned(right, *right_interval, "right")

    def keyed(rows: DataFrame, side: str, place: Column) -> DataFrame:
        """The rows of each group added up by cell."""
        own = wanted.items()
        rows = rows.select(*[F.col(f"{side}.{c}").alias(f"_on{i}") for i, c in enumerate(on)],
                           *[F.col(f"{side}.{c}").alias(f"_{side}{i}") for i, c in enumerate(per[side == "right"])],
                           *[F.col(f"{side}.{c}").alias(f"_of_{name}") for name, (s, c) in own if s == side],
                           F.explode(place).alias("_at"))
        groups = [c for c in rows.columns if not c.startswith("_of_") and c != "_at"]
        return rows.groupBy("_at.level", "_at.cell", *groups).agg(
            F.count(F.lit(1)).alias(f"_{side}_n"), *[F.sum(f"_of_{name}").alias(f"_of_{name}") for name, (s, _) in own if s == side])

    def starts_inside(inner: DataFrame, inner_side: str, outer: DataFrame, outer_side: str, first: Column) -> DataFrame:
        """Sums over the pairs whose inner row starts in the outer one's interval, from ``first`` on."""
        outer = outer.withColumn("_first", first).where("_first <= high")
        longest = outer.agg(F.max(F.col("high") - F.col("_first") + 1)).first()[0] or 0
        top = max((level for level in range(32) if CUT ** level <= longest), default=0)
        point = F.array(*[F.struct(F.lit(level).alias("level"), _floor(F.col("low"), CUT ** level).alias("cell"))
                          for level in range(top + 1)])
        joined = keyed(outer, outer_side, _cells(F.col("_first"), F.col("high") + 1, top)).join(
            keyed(inner, inner_side, point).hint("merge"), ["level", "cell", *[f"_on{i}" for i in range(len(on))]])
        other = {"left": "_right_n", "right": "_left_n"}
        return joined.select(*by, (F.col("_left_n") * F.col("_right_n")).alias("_n"),
                             *[(F.col(f"_of_{name}") * F.col(other[side])).alias(f"_of_{name}") for name, (side, _) in wanted.items()])

    by = [f"_{side}{i}" for side, columns in zip(("left", "right"), per) for i in range(len(columns))]
    met = starts_inside(r_rows, "right", l_rows, "left", F.col("low")).unionByName(
        starts_inside(l_rows, "left", r_rows, "right", F.col("low") + 1))
    return met.groupBy(*by).agg(F.sum("_n").alias(count), *[F.sum(f"_of_{name}").alias(name) for name in wanted]).select(
        *[F.col(c).alias(name) for c, name in zip(by, [*per[0], *per[1]])], count, *wanted)
