"""Tables that readers only ever see whole.

A table is a folder with two parts:

- ``data/[<column>=<value>/...]strata_version=<id>/`` Parquet files, never changed
  once written; every write has an id of its own;
- ``manifest/<number>.json`` the folders that make up version ``<number>``,
  written last, under another name first, and never changed.

The version with the greatest number is the table. A write that fails leaves
files that no manifest names; a reader that has resolved a version keeps its
files until ``vacuum`` drops that version. A write replaces the whole table,
or only the partitions it has rows for, or adds to it. One writer a table: a
second one that publishes the same number is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "strata_version"
#: What of the version before stays: nothing, partitions without new rows, everything.
ALL, PARTITIONS, APPEND = "all", "partitions", "append"


@dataclass(frozen=True)
class Manifest:
    """One version: its folders under ``data`` and what the writer noted in ``meta``."""

    number: int
    schema: T.StructType
    partition_by: list[str]
    leaves: list[str]
    meta: dict[str, Any] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(),
                           "partition_by": self.partition_by, "leaves": self.leaves, "meta": self.meta})

    @staticmethod
    def of(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["number"], T.StructType.fromJson(raw["schema"]), raw["partition_by"],
                        raw["leaves"], raw["meta"])


def partition_of(leaf: str) -> str:
    """The partition part of a leaf: ``a=1/b=2`` of ``a=1/b=2/strata_version=...``."""
    return leaf.rpartition("/")[0]


class Folder:
    """A folder of the file system that Spark uses for its path."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm = root.rstrip("/"), spark._jvm
        self._fs = self._at().getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def found(self, pattern: str) -> list[str]:
        """Paths under the root that match a pattern, relative to it."""
        head = self._fs.makeQualified(self._at()).toUri().getPath()
        return sorted(s.getPath().toUri().getPath()[len(head) + 1:] for s in self._fs.globStatus(self._at(pattern)) or [])

    def sizes(self, name: str) -> list[int]:
        """Sizes of the Parquet files of a folder."""
        at = self._at(name)
        return [s.getLen() for s in self._fs.listStatus(at) if s.getPath().getName().endswith(".parquet")]

    def size(self, name: str) -> int:
        return self._fs.getFileStatus(self._at(name)).getLen()

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file whole; False if there is one of that name."""
        folder, _, last = name.rpartition("/")
        part, final = self._at(f"{folder}/.{last}-{uuid.uuid4().hex[:12]}"), self._at(name)
        stream = self._fs.create(part, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(part, final):
            self._fs.delete(part, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _numbers(folder: Folder) -> list[int]:
    return sorted(int(n[:-5]) for n in folder.names("manifest") if n.endswith(".json") and not n.startswith("."))


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest of the current version; None where nothing is published."""
    folder = Folder(spark, root)
    numbers = _numbers(folder)
    return Manifest.of(folder.text(f"manifest/{numbers[-1]:012d}.json")) if numbers else None


def read(spark: SparkSession, root: str, manifest: Manifest | None = None) -> DataFrame:
    """The current (or a given) version; filters on partition columns prune its folders."""
    manifest = manifest or current(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    if not manifest.leaves:
        return spark.createDataFrame([], manifest.schema)
    base = f"{root.rstrip('/')}/data"
    stored = T.StructType([*manifest.schema.fields, T.StructField(VERSION, T.StringType())])
    rows = spark.read.schema(stored).option("basePath", base).parquet(*[f"{base}/{leaf}" for leaf in manifest.leaves])
    return rows.select(*manifest.schema.names)


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, mode: str = ALL,
            meta: dict[str, Any] | None = None, keep: int = 2) -> Manifest:
    """Write ``df`` and make it, with what stays by ``mode``, the next version.

    ``keep`` versions stay readable; files of older ones only are deleted.
    """
    if mode not in (ALL, PARTITIONS, APPEND):
        raise ValueError(f"unknown mode {mode!r}")
    spark, root = df.sparkSession, root.rstrip("/")
    folder, before, parts = Folder(spark, root), current(spark, root), list(partition_by or [])
    if before and mode != ALL and (before.partition_by != parts or before.schema.names != df.columns):
        raise ValueError(f"{root} has partitions {before.partition_by} and columns {before.schema.names}")
    number = before.number + 1 if before else 1
    mark = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    rows = df.hint("rebalance", *parts) if parts else df
    (rows.withColumn(VERSION, F.lit(mark)).write.mode("append").partitionBy(*parts, VERSION)
     .parquet(f"{root}/data"))
    new = [leaf[len("data/"):] for leaf in folder.found("data/" + "*/" * len(parts) + f"{VERSION}={mark}")]
    touched = {partition_of(leaf) for leaf in new}
    stays = [] if mode == ALL or not before else [
        leaf for leaf in before.leaves if mode == APPEND or partition_of(leaf) not in touched]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    manifest = Manifest(number, schema, parts, stays + new, dict(meta if meta is not None else before.meta if before else {}))
    if not folder.create(f"manifest/{number:012d}.json", manifest.to_json()):
        raise RuntimeError(f"version {number} of {root} was published by another writer")
    vacuum(spark, root, keep)
    return manifest


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` manifests, and the folders only those named.

    Folders that no manifest ever named (failed writes) go too, unless they are
    newer than the current version: their write may be running."""
    folder = Folder(spark, root)
    numbers = _numbers(folder)
    old, kept = numbers[:-max(1, keep)], numbers[-max(1, keep):]
    if not old:
        return []
    used = {leaf for n in kept for leaf in Manifest.of(folder.text(f"manifest/{n:012d}.json")).leaves}
    depth = len(Manifest.of(folder.text(f"manifest/{kept[-1]:012d}.json")).partition_by)
    there = [leaf[len("data/"):] for leaf in folder.found("data/" + "*/" * depth + f"{VERSION}=*")]
    gone = [leaf for leaf in there if leaf not in used
            and int(leaf.rpartition("=")[2].partition("-")[0]) <= kept[-1]]
    for n in old:                         # first the names, then the files
        folder.delete(f"manifest/{n:012d}.json")
    for leaf in gone:
        folder.delete(f"data/{leaf}")
    return gone


def compact(spark: SparkSession, root: str, max_leaves: int = 8, target_bytes: int = 256 << 20,
            keep: int = 2) -> Manifest | None:
    """Rewrite the partitions made of more than ``max_leaves`` folders into files of
    about ``target_bytes``, as the next version; the rows are the same.

    Returns the new manifest, or None where no partition has that many."""
    manifest = current(spark, root)
    if manifest is None:
        return None
    by_part: dict[str, list[str]] = {}
    for leaf in manifest.leaves:
        by_part.setdefault(partition_of(leaf), []).append(leaf)
    many = [leaf for leaves in by_part.values() if len(leaves) > max_leaves for leaf in leaves]
    if not many:
        return None
    folder = Folder(spark, root)
    size = sum(sum(folder.sizes(f"data/{leaf}")) for leaf in many)
    rows = read(spark, root, Manifest(manifest.number, manifest.schema, manifest.partition_by, many))
    if not manifest.partition_by:
        rows = rows.repartition(max(1, -(-size // target_bytes)))
    return publish(rows, root, manifest.partition_by, PARTITIONS, manifest.meta, keep)
