"""Tables with versions: snapshot, clone, restore, DML and atomic DML batches.

A version is one small JSON file that names, per partition value, the Parquet folders (or
single files of a folder) that make it up. A change rewrites only the files that hold rows it
touches and publishes the next version file in one rename; readers see the old version or the
new one, never a mixture. Of two writers that start from the same version, the second one
fails with VersionConflict.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from lakeops.operators.skew import rank_evenly
from lakeops.session import list_names, materialise, path_exists, put_json_if_absent, read_json

WHOLE = ""


@dataclass(frozen=True)
class Insert:
    rows: DataFrame


@dataclass(frozen=True)
class Update:
    values: dict[str, str | Column]
    where: str | Column


@dataclass(frozen=True)
class Delete:
    where: str | Column


@dataclass(frozen=True)
class Merge:
    """Matched rows take ``update`` expressions (which may use ``source.x``) or are deleted;
    unmatched source rows are inserted."""
    source: DataFrame
    keys: list[str]
    update: dict[str, str] = field(default_factory=dict)
    delete_matched: bool = False
    insert_unmatched: bool = True


def _condition(where: str | Column) -> Column:
    return F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ------------------------------------------------------------ versions

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows: DataFrame, partition_by: str | None = None,
               sort_by: list[str] = ()) -> VersionedTable:
        """``sort_by`` range-partitions and sorts every write, so that file and row-group
        statistics let reads and changes on those columns skip files."""
        table = cls(spark, path)
        schema = rows.schema
        if partition_by:
            # the partition value is a folder name, so it is kept last and as text
            others = [f for f in schema.fields if f.name != partition_by]
            schema = T.StructType([*others, T.StructField(partition_by, T.StringType())])
            rows = rows.withColumn(partition_by, F.col(partition_by).cast("string"))
        head = {"version": -1, "schema": schema.jsonValue(), "partition_by": partition_by,
                "sort_by": list(sort_by), "folders": {}, "transactions": {}}
        table._publish(head, table.stage(rows.select(*schema.names), head))
        return table

    def exists(self) -> bool:
        return bool(self.versions())

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in list_names(self.spark, f"{self.path}/versions") if n.endswith(".json")]

    def head(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            raise ValueError(f"no table at {self.path}")
        wanted = known[-1] if version is None else version
        if wanted not in known:
            raise ValueError(f"no version {wanted} at {self.path}")
        return read_json(self.spark, self._file(wanted))

    def read(self, version: int | None = None) -> DataFrame:
        head = self.head(version)
        return self._frame(head, sorted({f for fs in head["folders"].values() for f in fs}))

    def register(self, view: str, version: int | None = None) -> None:
        """Make a version known to SQL as a session view."""
        self.read(version).createOrReplaceTempView(view)

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def _frame(self, head: dict, folders: list[str], with_file: bool = False) -> DataFrame:
        schema = T.StructType.fromJson(head["schema"])
        file = [F.col("_metadata.file_path").alias("_from")] if with_file else []
        if not folders:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("_from", F.lit(None).cast("string")) if with_file else empty
        # clones name folders of another table, so each root is read with its own base path
        roots: dict[str, list[str]] = {}
        for folder in folders:
            roots.setdefault(folder.split("/commit=")[0], []).append(folder)
        frames = [self.spark.read.schema(schema).option("basePath", root).parquet(*paths)
                      .select(*schema.names, *file) for root, paths in sorted(roots.items())]
        return reduce(DataFrame.unionAll, frames)

    def stage(self, rows: DataFrame, head: dict, commit: str | None = None) -> dict[str, list[str]]:
        """Write rows under a commit folder; returns its folders per partition value.

        The same commit name replaces what an interrupted attempt left behind.
        """
        folder = f"{self.path}/data/commit={commit or uuid.uuid4().hex}"
        column = head["partition_by"]
        names = T.StructType.fromJson(head["schema"]).names
        rows = rows.select(*names)
        if head.get("sort_by"):
            rows = rank_evenly(rows, ([column] if column else []) + head["sort_by"])
        elif column:
            rows = rows.hint("rebalance", column)
        out = rows.write.mode("overwrite")
        (out.partitionBy(column) if column else out).parquet(folder)
        return self._folders(folder, column)

    def stage_flagged(self, rows: DataFrame, flag: str) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """Write rows once, split by a boolean column.

        Returns the folders of the false rows and those of the true rows. They lie under a
        root of their own, since folder levels must agree below one root.
        """
        column = self.head()["partition_by"]
        folder = f"{self.path}/loads/commit={uuid.uuid4().hex}"
        if column:
            rows = rows.hint("rebalance", flag, column)
        rows.write.partitionBy(flag, *([column] if column else [])).parquet(folder)
        found = [self._folders(f"{folder}/{flag}={value}", column) if path_exists(
            self.spark, f"{folder}/{flag}={value}") else {} for value in ("false", "true")]
        return found[0], found[1]

    def _folders(self, folder: str, column: str | None) -> dict[str, list[str]]:
        if not column:
            return {WHOLE: [folder]}
        return {n: [f"{folder}/{n}"] for n in list_names(self.spark, folder, dirs_only=True)}

    def staged(self, writer: str) -> dict[int, dict[str, list[str]]]:
        """Folders of a writer's numbered commits, published or not."""
        column, prefix = self.head()["partition_by"], f"commit={writer}-"
        return {int(n[len(prefix):]): self._folders(f"{self.path}/data/{n}", column)
                for n in list_names(self.spark, f"{self.path}/data", dirs_only=True)
                if n.startswith(prefix) and n[len(prefix):].isdigit()}

    def count_rows(self, folders: dict[str, list[str]]) -> int:
        """Rows in folders, from their footers."""
        return self._frame(self.head(), sorted(f for fs in folders.values() for f in fs)).count()

    def added_rows(self, old: dict, new: dict) -> int:
        """Rows in the folders that only the newer version has, counted from their footers."""
        known = {f for fs in old["folders"].values() for f in fs}
        fresh = sorted({f for fs in new["folders"].values() for f in fs} - known)
        return self._frame(new, fresh).count()

    def _publish(self, base: dict, added: dict[str, list[str]], kept: dict[str, list[str]] | None = None,
                 transactions: dict | None = None) -> int:
        """Publish the version after ``base``: what is kept of it (all, by default) and what is new."""
        folders = {p: list(fs) for p, fs in (base["folders"] if kept is None else kept).items() if fs}
        for partition, new in added.items():
            folders[partition] = folders.get(partition, []) + new
        version = base["version"] + 1
        put_json_if_absent(self.spark, self._file(version), {
            **base, "version": version, "folders": folders, "committed_ms": int(time.time() * 1000),
            "transactions": {**base.get("transactions", {}), **(transactions or {})}})
        return version

    def append(self, rows: DataFrame, transaction: tuple[str, int] | None = None) -> int:
        """Add rows. A transaction (writer, number) already published is skipped."""
        base = self.head()
        if transaction and base["transactions"].get(transaction[0], -1) >= transaction[1]:
            return base["version"]
        added = self.stage(rows, base)
        return self._publish(base, added, transactions=dict([transaction]) if transaction else None)

    def attach(self, staged: dict[str, list[str]], transaction: tuple[str, int] | None = None) -> int:
        """Publish folders staged earlier, all in one version."""
        return self._publish(self.head(), staged,
                             transactions=dict([transaction]) if transaction else None)

    def replace(self, rows: DataFrame) -> int:
        base = self.head()
        return self._publish(base, self.stage(rows, base), kept={})

    # ------------------------------------------------------------ snapshot, clone, restore

    def snapshot(self, name: str) -> None:
        """A read-only name for the present version."""
        put_json_if_absent(self.spark, f"{self.path}/snapshots/{name}.json",
                           {"version": self.head()["version"]})

    def read_snapshot(self, name: str) -> DataFrame:
        return self.read(self.snapshot_version(name))

    def snapshot_version(self, name: str) -> int:
        return read_json(self.spark, f"{self.path}/snapshots/{name}.json")["version"]

    def clone(self, path: str, version: int | None = None) -> VersionedTable:
        """A new writable table that starts from a version and shares its files."""
        other = VersionedTable(self.spark, path)
        if other.exists():
            raise ValueError(f"{path} already holds a table")
        other._publish({**self.head(version), "version": -1}, {})
        return other

    def restore(self, version: int) -> int:
        """Make an old version the newest one again."""
        old = self.head(version)
        return self._publish({**old, "version": self.head()["version"],
                              "transactions": self.head()["transactions"]}, {})

    # ------------------------------------------------------------ DML

    def execute(self, operation) -> int:
        """Run one change; returns the number of affected rows."""
        return self.execute_batch([operation])[0]

    def execute_batch(self, operations: list) -> list[int]:
        """Run changes in order as one version: all of them or none.

        The changes fold into one plan that marks rows instead of removing them. One
        aggregate over the marks gives the affected rows of each change and the files that
        hold them; only those files are read and written again. Expressions must be
        deterministic, since the plan runs once for the counts and once for the rows.
        """
        if not operations:
            raise ValueError("no operations")
        base = self.head()
        schema = T.StructType.fromJson(base["schema"])
        # sources and new rows are read several times below, so each is written down once
        operations = [replace(o, source=materialise(o.source, "merge")) if isinstance(o, Merge) else
                      replace(o, rows=materialise(o.rows, "insert")) if isinstance(o, Insert) else o for o in operations]
        marks = [f"_hit{n}" for n in range(len(operations))]

        def fold(paths: list[str]) -> DataFrame:
            rows = (self._frame(base, paths, with_file=True)
                        .withColumn("_old", F.lit(True)).withColumn("_gone", F.lit(False)))
            for number, operation in enumerate(operations):
                rows = self._mark(rows, operation, marks[number], marks[:number], schema)
            return rows

        everything = sorted({f for fs in base["folders"].values() for f in fs})
        changed = fold(everything)
        # one line per touched file: metadata, like the version file itself
        per_file = (changed.where(reduce(or_, [F.col(m) for m in marks])).groupBy("_from", "_old")
                           .agg(*[F.count_if(F.col(m)).alias(m) for m in marks]).collect())
        counts = [sum(r[m] for r in per_file) for m in marks]
        if not any(counts):
            return counts
        touched = sorted(r["_from"] for r in per_file if r["_old"])
        kept, paths = self._without(base, touched)
        if any(isinstance(o, Merge) and not (o.update or o.delete_matched) for o in operations):
            # files with matches stay as they are, so unmatched rows are decided against the whole table
            names = materialise(self.spark.createDataFrame([(t,) for t in touched], "_touched string"), "touched")
            hit = F.col("_from") == F.col("_touched")
            rewritten = changed.where(~F.col("_old")).unionByName(
                changed.where("_old").join(names, hit, "left_semi"))
        else:
            # every match is in a touched file, so those files decide alone
            rewritten = fold(paths)
        self._publish(base, self.stage(rewritten.where(~F.col("_gone")), base), kept)
        return counts

    def _without(self, base: dict, touched: list[str]) -> tuple[dict[str, list[str]], list[str]]:
        """The version's paths less the touched files, and the paths of those files.

        A folder with touched files gives way to the names of its other files. Reported file
        names are percent-encoded; commit names are unique, so paths compare from there on.
        """
        def tail(path: str) -> str:
            return path.split("/commit=", 1)[1]

        files = {tail(unquote(t)) for t in touched}
        folders = {f.rsplit("/", 1)[0] for f in files}
        kept: dict[str, list[str]] = {}
        taken: list[str] = []
        for partition, paths in base["folders"].items():
            kept[partition] = []
            for path in paths:
                if tail(path) in files:
                    taken.append(path)
                elif tail(path) in folders:
                    for name in list_names(self.spark, path):
                        full = f"{path}/{name}"
                        (taken if tail(full) in files else kept[partition]).append(full)
                else:
                    kept[partition].append(path)
        return kept, taken

    def _mark(self, rows: DataFrame, operation, mark: str, marks: list[str],
              schema: T.StructType) -> DataFrame:
        alive = ~F.col("_gone")
        if isinstance(operation, Delete):
            hit = alive & _condition(operation.where)
            return rows.withColumn(mark, hit).withColumn("_gone", F.col("_gone") | F.col(mark))
        if isinstance(operation, Update):
            marked = rows.withColumn(mark, alive & _condition(operation.where))
            return marked.select(
                *[self._assigned(f, operation.values, mark) for f in schema.fields],
                "_from", "_old", "_gone", *marks, mark)
        if isinstance(operation, Insert):
            return rows.withColumn(mark, F.lit(False)).unionByName(
                self._inserted(operation.rows, schema, mark, marks))
        if isinstance(operation, Merge):
            return self._merge(rows, operation, mark, marks, schema)
        raise TypeError(f"unknown operation {operation!r}")

    @staticmethod
    def _assigned(f: T.StructField, values: dict, mark: str) -> Column:
        if f.name not in values:
            return F.col(f"`{f.name}`")
        value = values[f.name]
        new = (F.expr(value) if isinstance(value, str) else value).cast(f.dataType)
        return F.when(F.col(mark), new).otherwise(F.col(f"`{f.name}`")).alias(f.name)

    @staticmethod
    def _inserted(new: DataFrame, schema: T.StructType, mark: str, marks: list[str]) -> DataFrame:
        columns = [(F.col(f"`{f.name}`") if f.name in new.columns else F.lit(None))
                   .cast(f.dataType).alias(f.name) for f in schema.fields]
        return new.select(*columns, F.lit(None).cast("string").alias("_from"),
                          F.lit(False).alias("_old"), F.lit(False).alias("_gone"),
                          *[F.lit(False).alias(m) for m in marks], F.lit(True).alias(mark))

    def _merge(self, rows: DataFrame, merge: Merge, mark: str, marks: list[str],
               schema: T.StructType) -> DataFrame:
        repeated = merge.source.groupBy(*merge.keys).count().where("count > 1")
        if repeated.head(1):
            raise ValueError("a merge source may hold each key once")
        source = merge.source.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(merge.keys)],
            F.struct("*").alias("source"))
        alive = rows.where(~F.col("_gone"))
        same = [alive[k] == source[f"_k{i}"] for i, k in enumerate(merge.keys)]
        joined = rows.join(source, reduce(lambda a, b: a & b, [
            rows[k] == source[f"_k{i}"] for i, k in enumerate(merge.keys)]) & ~rows["_gone"], "left")
        joined = joined.withColumn(mark, F.col("source").isNotNull()
                                   & F.lit(bool(merge.update) or merge.delete_matched))
        if merge.delete_matched:
            joined = joined.withColumn("_gone", F.col("_gone") | F.col(mark))
        out = joined.select(*[self._assigned(f, merge.update, mark) for f in schema.fields],
                            "_from", "_old", "_gone", *marks, mark)
        if not merge.insert_unmatched:
            return out
        fresh = source.join(alive, reduce(lambda a, b: a & b, same), "left_anti").select("source.*")
        return out.unionByName(self._inserted(fresh, schema, mark, marks))
