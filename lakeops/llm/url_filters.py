"""URL filters: a sorted array of 64-bit digests, memory-mapped by every task.

A rule is a host and a path prefix with a verdict. The digests (XXH64) of all rules lie sorted in
one file, next to the rules' own strings. Executors get the file through Spark's file
distribution and map it into memory, so a task holds only the pages that it touches. A batch of
URLs becomes one array of candidate digests (each parent domain with each path prefix whose length
some rule has), which one vectorised binary search probes; every digest that is found is confirmed
against the stored string, so that a collision of digests never decides.

A rule fits its host and all subdomains if the URL's path starts with the rule's path. The longest
fitting rule wins (host and path counted together, in bytes; at a tie the longer host). URLs that
no rule fits get ``default``. Null URLs and those without ``://`` have an empty host and path and
fit no rule. Repeated rules: the last one given counts. Repeated URLs each get their own row.
"""

from __future__ import annotations

import os
import string
import struct
import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import column, map_batches

#: (host, path prefix, verdict)
Rule = tuple[str, str, str]
VERDICTS = ("allow", "block")
_HEADER = struct.Struct("<QQQ")


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def write_rules(rules: Iterable[Rule], path: str) -> None:
    """Write the digest array: header, digests, string offsets, host lengths, verdicts, strings."""
    texts = {(h.encode(), p.encode()): VERDICTS.index(v) for h, p, v in rules}
    ordered = sorted(texts, key=lambda r: (xxhash.xxh64_intdigest(r[0] + r[1]), r))
    keys = np.array([xxhash.xxh64_intdigest(h + p) for h, p in ordered], np.uint64)
    offsets = np.cumsum([0, *(len(h) + len(p) for h, p in ordered)]).astype(np.int64)
    hosts = np.array([len(h) for h, _ in ordered], np.int64)
    verdicts = np.array([texts[r] for r in ordered], np.int64)
    lengths = np.array(sorted({len(p) for _, p in ordered}), np.int64)
    with open(path, "wb") as out:
        out.write(_HEADER.pack(len(ordered), len(lengths), int(offsets[-1])))
        for part in (keys, offsets, hosts, verdicts, lengths):
            out.write(part.tobytes())
        out.write(b"".join(h + p for h, p in ordered))


class RuleArray:
    """The memory-mapped file and its probe."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            n, m, size = _HEADER.unpack(file.read(_HEADER.size))
        at = _HEADER.size

        def part(count: int, kind: type) -> np.ndarray:
            nonlocal at
            width = np.dtype(kind).itemsize * count
            view = np.memmap(path, kind, "r", at, (count,)) if count else np.empty(0, kind)
            at += width
            return view

        self.keys, self.offsets = part(n, np.uint64), part(n + 1, np.int64)
        self.hosts, self.verdicts = part(n, np.int64), part(n, np.int64)
        self.lengths, self.strings = part(m, np.int64).tolist(), part(size, np.uint8)

    def rule(self, at: int) -> bytes:
        return self.strings[self.offsets[at]:self.offsets[at + 1]].tobytes()

    def find(self, probes: list[bytes], hosts: list[int]) -> np.ndarray:
        """For each probe (and the length of its host) the place of the equal rule, or -1."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), np.uint64, len(probes))
        found = np.full(len(probes), -1, np.int64)
        first = np.searchsorted(self.keys, digests)
        inside = np.flatnonzero(first < len(self.keys))
        for i in inside[self.keys[first[inside]] == digests[inside]].tolist():
            at = int(first[i])
            while at < len(self.keys) and self.keys[at] == digests[i]:
                if self.hosts[at] == hosts[i] and self.rule(at) == probes[i]:
                    found[i] = at
                    break
                at += 1
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[int]:
        """The place of the winning rule of each URL, or -1."""
        probes, widths, owners = [], [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            name, way = host.encode(), path.encode()
            prefixes = [way[:n] for n in self.lengths if n <= len(way)]
            while name:
                for prefix in prefixes:
                    probes.append(name + prefix)
                    widths.append(len(name))
                    owners.append(i)
                name = name.partition(b".")[2]
        best = [(-1, -1, -1)] * len(hosts)
        for at, i in zip(self.find(probes, widths).tolist(), owners):
            if at >= 0:
                length = int(self.offsets[at + 1] - self.offsets[at])
                best[i] = max(best[i], (length, int(self.hosts[at]), at))
        return [at for _, _, at in best]


def filter_urls(spark: SparkSession, pages: DataFrame, rules: Iterable[Rule], id_col: str = "page_id",
                url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: the id, host, path, winning rule and verdict.

    Only the id and the URL are read; other columns of ``pages`` do not matter.
    """
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    built = os.path.join(tempfile.mkdtemp(prefix="url-rules-"), name)
    write_rules(rules, built)
    spark.sparkContext.addFile(built)  # Spark hands it to every executor, also to later ones
    urls = pages.select(F.col(id_col), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    kind = urls.schema[id_col].dataType.simpleString()

    def judge(batches):
        array = RuleArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = column(batch, "host").to_pylist(), column(batch, "path").to_pylist()
            won = array.judge(hosts, paths)
            yield pa.RecordBatch.from_arrays([
                *batch.columns,
                pa.array([array.rule(at).decode() if at >= 0 else None for at in won], pa.string()),
                pa.array([VERDICTS[array.verdicts[at]] if at >= 0 else default for at in won], pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return map_batches(urls, f"`{id_col}` {kind}, host string, path string, rule string, verdict string", judge)
