"""Streaming writes into a versioned table with three delivery modes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from lakeops.operators.versioned import VersionedTable
from lakeops.session import path_exists, read_json, scratch_dir

# Delivery modes.
MODES = ("DEFAULT", "COMMITTED", "PENDING")


@dataclass
class Written:
    """Rows that this call published, the version that holds them, and when it was published."""
    rows: int
    version: int
    committed_ms: int | None


def stream_write(stream: DataFrame, table: VersionedTable, writer: str, mode: str = "DEFAULT",
                 checkpoint: str | None = None, replay: bool = False) -> Written:
    """Drain a stream into a table that already exists.

    DEFAULT appends each batch, at least once. COMMITTED also appends each batch at once, and
    stores the batch number in the version it publishes, so a repeated batch is skipped.
    PENDING keeps all batches invisible, each under its own number, and publishes them in
    one version at the end; a repeated batch replaces its earlier attempt.

    Batch numbers count within one checkpoint, so COMMITTED and PENDING need one, and numbers
    are kept by writer and by the id that Spark keeps in it. A known writer with another
    checkpoint is refused, since its batches cannot be told from published ones; ``replay=True``
    says that the stream's rows are new, or are wanted again.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    if mode != "DEFAULT" and not checkpoint:
        raise ValueError(f"{mode} needs a checkpoint")
    if not table.exists():
        raise ValueError(f"no table at {table.path}")
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, "checkpoint")
    start = table.head()
    own: dict[str, list[str]] = {}
    versions: list[int] = []

    def ledger() -> str:
        return f"{writer}@{read_json(spark, f'{checkpoint}/metadata')['id']}"

    def published() -> int:
        return table.head()["transactions"].get(ledger(), -1)

    def keep(folders: dict[str, list[str]]) -> None:
        for partition, names in folders.items():
            own.setdefault(partition, []).extend(names)

    known = [k for k in start["transactions"] if k.rsplit("@", 1)[0] == writer]
    if mode != "DEFAULT" and known and not replay and not (
            path_exists(spark, f"{checkpoint}/metadata") and ledger() in known):
        raise ValueError(f"{writer} has written with another checkpoint; give that one, or replay=True")

    def write(batch: DataFrame, batch_id: int) -> None:
        if mode == "DEFAULT":
            added = table.stage(batch, table.head())
            versions.append(table.attach(added))
            keep(added)
        elif batch_id <= published():
            return
        elif mode == "PENDING":
            table.stage(batch, start, commit=f"{ledger()}-{batch_id}")
        else:
            added = table.stage(batch, table.head())
            versions.append(table.attach(added, (ledger(), batch_id)))
            keep(added)

    query = (stream.writeStream.foreachBatch(write).trigger(availableNow=True)
                   .option("checkpointLocation", checkpoint).start())
    query.awaitTermination()
    if mode == "PENDING":
        # found by name, so batches staged before a restart are part of the commit too
        done = published()
        staged = {n: f for n, f in table.staged(ledger()).items() if n > done}
        for number in sorted(staged):
            keep(staged[number])
        if staged:
            versions.append(table.attach(own, (ledger(), max(staged))))
    if not versions:
        return Written(0, table.head()["version"], None)
    head = table.head(versions[-1])
    return Written(table.count_rows(own), versions[-1], head.get("committed_ms"))
