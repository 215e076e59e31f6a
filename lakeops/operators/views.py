"""Views with their functions, and materialized views that refresh from new files only."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import list_names, put_json_if_absent, read_json


@dataclass(frozen=True)
class InlineFunction:
    """A SQL function, for example ``net(x DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN x * (1 - d)``."""
    definition: str


@dataclass(frozen=True)
class FileFunction:
    """A function object in a Python file that is shipped to the executors."""
    uri: str
    module: str
    name: str


def create_view(spark: SparkSession, name: str, query: str, functions: list = ()) -> None:
    """A view and the functions it uses.

    With SQL functions only, everything lives in the catalog. A view over Python functions
    belongs to the session, as they do.
    """
    temporary = False
    for function in functions:
        if isinstance(function, InlineFunction):
            spark.sql(f"CREATE OR REPLACE FUNCTION {function.definition}")
        else:
            import importlib
            spark.sparkContext.addPyFile(function.uri)
            module = importlib.import_module(function.module)
            # batches of rows travel as Arrow; the function itself stays one of single values
            spark.udf.register(function.name, F.udf(getattr(module, function.name), useArrow=True))
            temporary = True
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {query}")


class MaterializedView:
    """Stored sums and counts over append-only base files.

    A refresh aggregates only files that are not in the file list of the stored state and
    merges the result into the stored groups. If a known file vanished or changed, everything
    is computed again. State, file list and groups of one refresh are published together.
    Key and sum expressions use columns stored in the files.
    """

    def __init__(self, spark: SparkSession, path: str, base: str, keys: dict[str, str],
                 sums: dict[str, str], *, enable_refresh: bool = True, min_interval_ms: int = 1_800_000):
        self.spark, self.path, self.base = spark, path.rstrip("/"), base
        self.keys, self.sums = keys, sums
        self.enable_refresh, self.min_interval_ms = enable_refresh, min_interval_ms

    def state(self) -> dict | None:
        names = list_names(self.spark, f"{self.path}/state")
        return read_json(self.spark, f"{self.path}/state/{names[-1]}") if names else None

    def read(self) -> DataFrame:
        state = self.state()
        if state is None:
            raise ValueError("never refreshed")
        return self.spark.read.parquet(state["groups"])

    def _files(self) -> DataFrame:
        return (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                    .load(self.base).select("path", "length", F.unix_micros("modificationTime").alias("modified")))

    def _aggregate(self, rows: DataFrame) -> DataFrame:
        keyed = rows.select(*[F.expr(e).alias(k) for k, e in self.keys.items()],
                            *[F.expr(e).alias(s) for s, e in self.sums.items()])
        return keyed.groupBy(*self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])

    def refresh(self, now_ms: int | None = None, force: bool = False) -> str:
        """Returns ``full``, ``incremental``, ``unchanged``, ``too_soon`` or ``disabled``."""
        now_ms = int(time.time() * 1000) if now_ms is None else now_ms
        state = self.state()
        if not force and not self.enable_refresh:
            return "disabled"
        if not force and state and now_ms - state["refreshed_ms"] < self.min_interval_ms:
            return "too_soon"
        files = self._files()
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        files.write.parquet(f"{folder}/files")
        files = self.spark.read.parquet(f"{folder}/files")
        mode, reader = "full", self.spark.read
        rows = reader.parquet(self.base)
        if state:
            known = self.spark.read.parquet(state["files"])
            same = ["path", "length", "modified"]
            fresh = files.join(known, same, "left_anti")
            lost = known.join(files, same, "left_anti")
            if not lost.head(1):
                if not fresh.head(1):
                    return "unchanged"
                mode = "incremental"
                # names of the files added since the last refresh: metadata, not rows
                paths = [r["path"] for r in fresh.select("path").collect()]
                rows = reader.schema(rows.schema).option("basePath", self.base).parquet(*paths)
        groups = self._aggregate(rows)
        if mode == "incremental":
            merged = groups.unionByName(self.spark.read.parquet(state["groups"]))
            groups = merged.groupBy(*self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])
        groups.write.parquet(f"{folder}/groups")
        number = (state["number"] + 1) if state else 0
        put_json_if_absent(self.spark, f"{self.path}/state/{number:012d}.json", {
            "number": number, "refreshed_ms": now_ms, "mode": mode,
            "groups": f"{folder}/groups", "files": f"{folder}/files"})
        return mode
