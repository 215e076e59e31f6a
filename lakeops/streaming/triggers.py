"""Triggers that remember: conditions over the running result of a whole table, and over look-back windows of series.

Both report a key once when its condition begins to hold (``ENTER``) and once when it ends (``LEAVE``). The
running results are streaming aggregates, combined before the shuffle, so that a key with a third of all rows costs a
line for each task. What is reported is written by micro-batch number, and so is the set of keys whose
condition holds: a batch that is repeated after a failure reads the set of the batch before and writes the same
folders again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.skew import join_small
from lakeops.session import delete_path, list_names

ENTER, LEAVE = "ENTER", "LEAVE"


def _number(name: str) -> int:
    return int(name.split("=")[1])


class _Ledger:
    """Folders ``events/batch=N`` and ``holding/batch=N``; a batch sees those of earlier ones only."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def holding(self, batch_id: int) -> DataFrame:
        earlier = [n for n in list_names(self.spark, f"{self.path}/holding", dirs_only=True) if _number(n) < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/holding/{max(earlier, key=_number)}")

    def judged(self, rows: DataFrame) -> DataFrame:
        """The batch, written down: it is read several times, and must be the same each time."""
        rows.write.mode("overwrite").parquet(f"{self.path}/judged")
        return self.spark.read.schema(rows.schema).parquet(f"{self.path}/judged")

    def write(self, batch_id: int, events: DataFrame, holding: DataFrame) -> None:
        # events first: until the set is there, the batch counts as not done and writes both again
        events.write.mode("overwrite").parquet(f"{self.path}/events/batch={batch_id}")
        holding.write.mode("overwrite").parquet(f"{self.path}/holding/batch={batch_id}")
        # only the batch before this one can still be asked for
        for name in list_names(self.spark, f"{self.path}/holding", dirs_only=True):
            if _number(name) < batch_id - 1 and _number(name) < self._last_before(batch_id):
                delete_path(self.spark, f"{self.path}/holding/{name}")

    def _last_before(self, batch_id: int) -> int:
        return max((_number(n) for n in list_names(self.spark, f"{self.path}/holding", dirs_only=True) if _number(n) < batch_id), default=-1)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """What a trigger reported so far, with the micro-batch that did."""
    return spark.read.option("basePath", f"{path}/events").parquet(f"{path}/events")


def watch_table(base: DataFrame, keys: dict[str, str], measures: dict[str, str], condition: str,
                path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Watch ``SELECT keys, measures FROM base GROUP BY keys HAVING condition`` over all rows that ever came.

    ``keys`` and ``measures`` map names to SQL expressions; without keys there is one group. After each micro-batch, groups that
    changed are held against the condition. A poll of the same query finds a group exactly from its ENTER
    to its LEAVE. A condition that is null does not hold.
    """
    names = list(keys)
    grouped = base.groupBy(*[F.expr(e).alias(k) for k, e in keys.items()]) if keys else base.groupBy()
    running = grouped.agg(*[F.expr(e).alias(m) for m, e in measures.items()])
    held_schema = T.StructType([running.schema[k] for k in names] + [T.StructField("_holds", T.BooleanType())])
    holds = F.coalesce(F.expr(condition), F.lit(False))

    def check(batch: DataFrame, batch_id: int) -> None:
        ledger = _Ledger(batch.sparkSession, path, held_schema)
        before = ledger.holding(batch_id)
        now = ledger.judged(batch.select(*names, *measures, holds.alias("_now")))
        renamed = before.select(*[F.col(k).alias(f"_k_{k}") for k in names], F.col("_holds"))
        same = F.lit(True)
        for k in names:
            same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        if names:
            both = now.join(renamed, same, "left")
        else:  # one row on either side
            both = join_small(now.withColumn("_one", F.lit(1)), renamed.withColumn("_one", F.lit(1)), ["_one"], "left")
        was = F.coalesce("_holds", F.lit(False))
        events = both.where(F.col("_now") != was).select(
            *names, *measures, F.when(F.col("_now"), ENTER).otherwise(LEAVE).alias("change"))
        changed = now.select(*[F.col(k).alias(f"_n_{k}") for k in names], F.lit(1).alias("_seen"))
        unseen = F.lit(True)
        for k in names:
            unseen &= F.col(k).eqNullSafe(F.col(f"_n_{k}"))
        rest = before.join(changed, unseen, "left_anti") if names else before.limit(0)
        ledger.write(batch_id, events, rest.unionByName(now.where("_now").select(*names, F.lit(True).alias("_holds"))))

    return (running.writeStream.outputMode("update").foreachBatch(check).trigger(**(trigger or {"availableNow": True}))
                   .option("checkpointLocation", checkpoint).start())


def watch_windows(points: DataFrame, keys: list[str], measures: dict[str, str], condition: str, path: str, checkpoint: str, *,
                  time: str = "end_ts", window: str = "1 hour", slide: str = "10 minutes", delay: str = "10 minutes",
                  trigger: dict | None = None) -> StreamingQuery:
    """Watch the series of ``keys`` over the last ``window`` of event time, at every ``slide``.

    At an instant T a series matches if its points with T - window <= time < T fulfil the condition over the ``measures``. An
    instant is judged when the watermark, the newest time less ``delay``, has passed it. A series gets an ENTER at the
    first instant at which it matches and a LEAVE at the first one after at which it does not, also where no
    points are left. ``events`` has the keys, ``at`` and ``change``; instants up to the newest judged one are final.
    """
    at = F.window(time, window, slide)
    closed = (points.withWatermark(time, delay).groupBy(*keys, at.alias("_window"))
                    .agg(*[F.expr(e).alias(m) for m, e in measures.items()])
                    .select(*keys, F.col("_window.end").alias("at"), F.coalesce(F.expr(condition), F.lit(False)).alias("_holds")))
    held_schema = T.StructType([closed.schema[k] for k in keys] + [T.StructField("at", T.TimestampType()), T.StructField("_high", T.TimestampType())])
    step = F.expr(f"INTERVAL {slide}")

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = _Ledger(spark, path, held_schema)
        before = ledger.holding(batch_id)
        judged = ledger.judged(batch)
        highs = [r[0] for r in (judged.agg(F.max("at")).first(), before.agg(F.max("_high")).first()) if r[0] is not None]
        if highs:
            high = F.lit(max(highs))
            events, active = _transitions(judged.where("_holds").select(*keys, "at"), before.where("at is not null"), keys, step, high)
            # the newest judged instant stays on record also when no series matches
            mark = spark.range(1).select(*[F.lit(None).cast(held_schema[k].dataType).alias(k) for k in keys],
                                         F.lit(None).cast("timestamp").alias("at"), high.alias("_high"))
            ledger.write(batch_id, events, active.withColumn("_high", high).unionByName(mark))

    return (closed.writeStream.outputMode("append").foreachBatch(check).trigger(**(trigger or {"availableNow": True}))
                  .option("checkpointLocation", checkpoint).start())


def _transitions(matched: DataFrame, active: DataFrame, keys: list[str], step: Column, high: Column) -> tuple[DataFrame, DataFrame]:
    """ENTER and LEAVE events of newly judged matches, and the series that still match at ``high`` with their last instant.

    Neighbours of an instant are found by equality of (key, instant), not in a window over a series.
    """
    known = matched.select(*keys, "at", F.lit(False).alias("_old")).unionByName(active.select(*keys, "at", F.lit(True).alias("_old")))

    def beside(rows: DataFrame, shift: Column) -> DataFrame:
        other = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys], shift.alias("_at"))
        same = F.col("at") == F.col("_at")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        return rows.join(other, same, "left_anti")

    first = beside(known.where(~F.col("_old")), F.col("at") + step)
    last = beside(known, F.col("at") - step)
    gone = last.where(F.col("at") + step <= high)
    events = first.select(*keys, "at", F.lit(ENTER).alias("change")).unionByName(
        gone.select(*keys, (F.col("at") + step).alias("at"), F.lit(LEAVE).alias("change")))
    return events, last.where(F.col("at") + step > high).select(*keys, "at")
