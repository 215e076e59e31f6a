"""Materialized views over a stored aggregate query, kept up to date from new files only.

The query is ``SELECT keys and aggregates FROM ... [WHERE ...] GROUP BY keys`` over named sources, folders of
append-only Parquet files. Its select list is replaced by *states* that merge: sums, counts, least and greatest values,
and HLL sketches for ``approx_count_distinct``. What is stored are the states of each group, never the rows.

A refresh lists the files of the sources and runs the same FROM, WHERE and GROUP BY over what is new:
with sources A and B, new rows of A against all of B, and old rows of A against new rows of B. That is exact for
inner joins. With left outer joins only new files of the leftmost source can be added; other changes, vanished or
rewritten files, and queries outside this form are computed again as a whole.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import list_names, put_json_if_absent, read_json

#: Names of new files that are handed to the reader; beyond, files are selected by a join on their name.
MAX_PATHS = 10_000

#: For each aggregate: what is computed of rows, how two states become one, and the value of a state.
#: ``{x}`` is the argument, ``{0}``, ``{1}`` are state columns.
_SUM, _COUNT = ("sum({x})", "sum({0})"), ("count({x})", "sum({0})")
MERGEABLE: dict[str, tuple[list[tuple[str, str]], str]] = {
    "sum": ([_SUM], "{0}"),
    "count": ([_COUNT], "coalesce({0}, 0)"),
    "avg": ([_SUM, _COUNT], "{0} / {1}"),
    "mean": ([_SUM, _COUNT], "{0} / {1}"),
    "min": ([("min({x})", "min({0})")], "{0}"),
    "max": ([("max({x})", "max({0})")], "{0}"),
    "bool_and": ([("bool_and({x})", "bool_and({0})")], "{0}"),
    "bool_or": ([("bool_or({x})", "bool_or({0})")], "{0}"),
    # the union makes the estimate depend on the registers alone, not on the order of rows
    "approx_count_distinct": ([("hll_sketch_agg({x})", "hll_union_agg({0})")], "coalesce(hll_sketch_estimate(hll_union({0}, {0})), 0)"),
}


@dataclass
class StateQuery:
    """The parts of a stored query: SQL of the states, how to merge and finish them, and the joins it makes."""
    keys: list[str]
    states: list[tuple[str, str, str]]  # name, aggregate of rows, aggregate of states
    finished: dict[str, str]
    head: str
    tail: str
    relations: list[str]
    joins: list[str]
    plain: bool

    @classmethod
    def parse(cls, spark: SparkSession, text: str) -> StateQuery:
        """Spark's parser takes the text apart; anything but one aggregate over joins and filters is refused."""
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        if _kind(plan) not in ("Aggregate", "Project"):
            raise ValueError("a stored query is SELECT ... FROM ... GROUP BY ... without HAVING, ORDER BY or LIMIT")
        # without GROUP BY, the parser takes the aggregates of the whole for a projection
        grouping = _items(plan.groupingExpressions()) if _kind(plan) == "Aggregate" else []
        named = _items(plan.aggregateExpressions() if _kind(plan) == "Aggregate" else plan.projectList())
        if any(_kind(e) == "UnresolvedOrdinal" or e.sql().isdigit() for e in grouping):
            raise ValueError("name the keys in GROUP BY, not their positions")
        keys, states, finished = [], [], {}
        for expression in named:
            if _kind(expression) not in ("Alias", "UnresolvedAttribute"):
                raise ValueError(f"give {expression.sql()} a name")
            name = expression.name() if _kind(expression) == "Alias" else expression.sql().rsplit(".", 1)[-1].strip("`")
            value = _items(expression.children())[0] if _kind(expression) == "Alias" else expression
            calls = _aggregates(value)
            if calls:
                sql = value.sql()
                for call in calls:
                    columns = []
                    for rows, merge in MERGEABLE[call.nameParts().last().lower()][0]:
                        column = f"_s{len(states)}"
                        argument = ", ".join(x.sql() for x in _items(call.children()))
                        states.append((column, rows.replace("{x}", argument), merge.replace("{0}", column)))
                        columns.append(column)
                    done = MERGEABLE[call.nameParts().last().lower()][1]
                    for i, column in enumerate(columns):
                        done = done.replace(f"{{{i}}}", column)
                    sql = sql.replace(call.sql(), f"({done})")
                finished[name] = sql
            else:
                keys.append(f"{value.sql()} AS `{name}`")
                finished[name] = f"`{name}`"
        if len(keys) != len(grouping):
            raise ValueError("the select list holds every key of GROUP BY, and only those beside aggregates")
        relations, joins, plain = _sources(plan.child())
        return cls(keys, states, finished, text[:named[0].origin().startIndex().get()],
                   text[named[-1].origin().stopIndex().get() + 1:], relations, joins, plain)

    def key_names(self) -> list[str]:
        return [n for n, sql in self.finished.items() if sql == f"`{n}`"]

    def of_rows(self) -> str:
        return self.head + ", ".join([*self.keys, *[f"{rows} AS {name}" for name, rows, _ in self.states]]) + self.tail

    def merged(self, states: DataFrame, stored: DataFrame) -> DataFrame:
        """One state for each group, of the stored types: sums of decimals would widen with each refresh."""
        both = states.unionByName(stored)
        return both.groupBy(*[F.col(f"`{k}`") for k in self.key_names()]).agg(
            *[F.expr(merge).cast(stored.schema[name].dataType).alias(name) for name, _, merge in self.states])

    def maintainable(self, changed: list[str]) -> bool:
        """Whether new rows of the changed sources only ever add to the states."""
        if not self.plain or len(set(self.relations)) < len(self.relations):
            return False
        if all(j in ("INNER", "CROSS") for j in self.joins):
            return True
        return set(self.joins) <= {"INNER", "LEFT OUTER"} and changed == self.relations[:1]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _aggregates(expression) -> list:
    """The calls of aggregate functions in an expression, which must all be ones that merge."""
    if _kind(expression) == "UnresolvedFunction":
        name = expression.nameParts().last().lower()
        if name in MERGEABLE:
            if expression.isDistinct() or expression.filter().isDefined():
                raise ValueError(f"{expression.sql()}: DISTINCT and FILTER do not merge")
            return [expression]
    return [call for child in _items(expression.children()) for call in _aggregates(child)]


def _sources(plan) -> tuple[list[str], list[str], bool]:
    """Names of the sources from left to right, kinds of the joins, and whether there is nothing but joins and filters."""
    kind = _kind(plan)
    if kind == "UnresolvedRelation":
        return [".".join(_items(plan.multipartIdentifier()))], [], True
    relations, joins = [], [plan.joinType().sql()] if kind == "Join" else []
    plain = kind in ("Join", "Filter", "SubqueryAlias") and not any(_subquery(e) for e in _items(plan.expressions()))
    for child in _items(plan.children()):
        own, inner, good = _sources(child)
        relations, joins, plain = relations + own, joins + inner, plain and good
    return relations, joins, plain


def _subquery(expression) -> bool:
    return "Subquery" in _kind(expression) or _kind(expression) == "Exists" or any(_subquery(c) for c in _items(expression.children()))


class StoredQueryView:
    """A materialized view: query, sources (name to folder), states and file lists of each refresh."""

    def __init__(self, spark: SparkSession, path: str, query: str, sources: dict[str, str], *,
                 enable_refresh: bool = True, min_interval_ms: int = 1_800_000):
        self.spark, self.path, self.query, self.sources = spark, path.rstrip("/"), query, sources
        self.enable_refresh, self.min_interval_ms = enable_refresh, min_interval_ms
        self.parts = StateQuery.parse(spark, query)
        unknown = set(self.parts.relations) - set(sources)
        if unknown:
            raise ValueError(f"the query reads {sorted(unknown)}, which are no sources")

    def state(self) -> dict | None:
        names = list_names(self.spark, f"{self.path}/state")
        return read_json(self.spark, f"{self.path}/state/{names[-1]}") if names else None

    def read(self) -> DataFrame:
        """The result of the query as of the last refresh, with the query's own columns and types."""
        state = self.state()
        if state is None:
            raise ValueError("never refreshed")
        types = self._schema()
        stored = self.spark.read.parquet(state["groups"])
        return stored.select(*[F.expr(sql).cast(types[name].dataType).alias(name) for name, sql in self.parts.finished.items()])

    def _schema(self):
        return self._run(self.query, {name: self._all(name) for name in self.sources}).schema

    def _all(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.sources[name])

    def _run(self, sql: str, frames: dict[str, DataFrame]) -> DataFrame:
        """The SQL with the sources' names standing for these frames; they get names of their own for the while."""
        names = {name: f"_{uuid.uuid4().hex}" for name in frames}
        for name, frame in frames.items():
            frame.createOrReplaceTempView(names[name])
        bound = ", ".join(f"`{name}` AS (SELECT * FROM {own})" for name, own in names.items())
        try:
            return self.spark.sql(f"WITH {bound} {sql}")
        finally:
            for own in names.values():
                self.spark.catalog.dropTempView(own)

    def _files(self) -> DataFrame:
        listings = [
            self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
                .select(F.lit(name).alias("source"), "path", "length", F.unix_micros("modificationTime").alias("modified"))
            for name, path in self.sources.items()]
        return reduce(DataFrame.unionByName, listings)

    def _rows_of(self, name: str, files: DataFrame, kept: bool) -> DataFrame:
        """The rows of a source in the given new files, or in all others."""
        rows, own = self._all(name), files.where(F.col("source") == name)
        if kept:
            paths = [r["path"] for r in own.select("path").limit(MAX_PATHS + 1).collect()]
            if len(paths) <= MAX_PATHS:
                return self.spark.read.schema(rows.schema).option("basePath", self.sources[name]).parquet(*paths)
        known = own.select(F.col("path").alias("_path"))
        at = rows.withColumn("_at", F.col("_metadata.file_path"))
        return at.join(known, F.col("_at") == F.col("_path"), "left_semi" if kept else "left_anti").drop("_at")

    def _delta(self, fresh: DataFrame, changed: list[str]) -> DataFrame:
        """States of what new files add: each source's new rows, with sources before it as they are now and those after it as they were."""
        terms = []
        for name in changed:
            frames = {}
            for other in self.parts.relations:
                before = self.parts.relations.index(other) < self.parts.relations.index(name)
                if other == name:
                    frames[other] = self._rows_of(other, fresh, True)
                else:
                    frames[other] = self._all(other) if before or other not in changed else self._rows_of(other, fresh, False)
            terms.append(self._run(self.parts.of_rows(), frames))
        return reduce(DataFrame.unionByName, terms)

    def refresh(self, now_ms: int | None = None, force: bool = False) -> str:
        """Returns ``full``, ``incremental``, ``unchanged``, ``too_soon`` or ``disabled``."""
        now_ms = int(time.time() * 1000) if now_ms is None else now_ms
        state = self.state()
        if not force and not self.enable_refresh:
            return "disabled"
        if not force and state and now_ms - state["refreshed_ms"] < self.min_interval_ms:
            return "too_soon"
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        self._files().write.parquet(f"{folder}/files")
        files = self.spark.read.parquet(f"{folder}/files")
        mode = "full"
        if state and state["query"] == self.query:
            known, same = self.spark.read.parquet(state["files"]), ["source", "path", "length", "modified"]
            fresh = files.join(known, same, "left_anti")
            if not known.join(files, same, "left_anti").head(1):
                changed = sorted((r["source"] for r in fresh.select("source").distinct().collect()), key=self.parts.relations.index)
                if not changed:
                    return "unchanged"
                if self.parts.maintainable(changed):
                    mode = "incremental"
        if mode == "incremental":
            groups = self.parts.merged(self._delta(fresh, changed), self.spark.read.parquet(state["groups"]))
        else:
            groups = self._run(self.parts.of_rows(), {name: self._all(name) for name in self.sources})
        groups.write.parquet(f"{folder}/groups")
        number = (state["number"] + 1) if state else 0
        put_json_if_absent(self.spark, f"{self.path}/state/{number:012d}.json", {
            "number": number, "refreshed_ms": now_ms, "mode": mode, "query": self.query,
            "groups": f"{folder}/groups", "files": f"{folder}/files"})
        return mode
