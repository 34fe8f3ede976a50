"""Compaction of a stream's output while the stream goes on.

Every micro-batch leaves files of its own, so many short batches leave many
small files. ``compact_output`` copies the committed files that it has not yet
copied into files of about ``target_bytes``, in a table of published versions
(``sinks.versions``) beside the output, and ``read_output`` reads that table
and, of the output, only the files committed since: each row once.

The output folder and its commit log are left as they are, so the stream that
writes it and the streams that read it see nothing of a compaction: no file
appears twice, none is lost when a compaction fails. What has been copied is a
second small table, whose rows count up to the round that the copy's manifest
names; a round that failed halfway is dropped by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks import versions as V

FILES_SCHEMA = "file string, round long"


def _copied(spark: SparkSession, root: str) -> tuple[V.Manifest | None, DataFrame]:
    """The copy's manifest and the files that it holds."""
    rows, files = V.current(spark, f"{root}/rows"), V.current(spark, f"{root}/files")
    if rows is None or files is None:
        return None, spark.createDataFrame([], FILES_SCHEMA)
    return rows, V.read(spark, f"{root}/files", files).where(F.col("round") <= rows.meta["round"])


def _split(spark: SparkSession, path: str, root: str) -> tuple[V.Manifest | None, DataFrame, list[str], DataFrame]:
    output = spark.read.parquet(path)
    # A folder written by a stream is listed through its commit log: only whole batches.
    committed = output.inputFiles()
    rows, files = _copied(spark, root)
    done = {r.file for r in files.select("file").collect()}
    return rows, files, sorted(set(committed) - done), output


def compact_output(spark: SparkSession, path: str, root: str, target_bytes: int = 256 << 20,
                   min_files: int = 2, max_leaves: int = 8) -> V.Manifest | None:
    """Copy the files committed under ``path`` since the last round into the table at ``root``.

    With fewer than ``min_files`` of them nothing happens (None). When the copy has
    more than ``max_leaves`` folders they are merged too, so it has at most about
    size / ``target_bytes`` + ``max_leaves`` files."""
    root = root.rstrip("/")
    before, files, new, output = _split(spark, path, root)
    if len(new) < min_files:
        return None
    number = (before.meta["round"] if before else 0) + 1
    copied = files.unionByName(spark.createDataFrame([(f, number) for f in new], FILES_SCHEMA))
    # Written whole: rows of a round that did not get to its end go.
    V.publish(copied.repartition(1), f"{root}/files")
    size = sum(V.Folder(spark, f.rpartition("/")[0]).size(f.rpartition("/")[2]) for f in new)
    rows, wanted = spark.read.schema(output.schema).parquet(*new), max(1, -(-size // target_bytes))
    # A task reads the small files of one target file; rows move only where splits are larger than that.
    rows = rows.coalesce(wanted) if wanted <= rows.rdd.getNumPartitions() else rows.repartition(wanted)
    out = V.publish(rows, f"{root}/rows", mode=V.APPEND, meta={"round": number})
    return V.compact(spark, f"{root}/rows", max_leaves, target_bytes) or out


def read_output(spark: SparkSession, path: str, root: str) -> DataFrame:
    """All committed rows of the output: the copy, and the files not yet in it."""
    rows, _, new, output = _split(spark, path, root.rstrip("/"))
    parts = [V.read(spark, f"{root.rstrip('/')}/rows", rows)] if rows else []
    if new or not parts:
        parts.append(spark.read.schema(output.schema).parquet(*new) if new else output)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
