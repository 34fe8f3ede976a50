"""Batch sinks.

Writes are distributed: every task writes its own part files and the driver
only commits. ``single_file`` (one output file through one task) is an
explicit opt-in for small extracts. Partitioned writes use the AQE
``REBALANCE`` hint: rows are shuffled by the partition column, hot values are
split across several tasks (files) and small ones coalesced, so neither a
huge year nor thousands of tiny files stall the job.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import EMPTY_PARTITION


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               single_file: bool = False, compression: str | None = None, level: str | None = None) -> str:
    """Query result -> JSON-lines files under ``path``.

    ``single_file`` shuffles the result into one partition for the write;
    unlike ``coalesce(1)`` this keeps the upstream work spread over all tasks.
    ``compression`` (``"gzip"``): names and repeated values make up most of a JSON
    line, so files are several times smaller; a reader takes such a file whole,
    in one task, so the caller sees to the size of the partitions. ``level``: Hadoop's
    name of a zlib level (``"BEST_SPEED"``, ``"TWO"``, ...), the file system's default if unset.
    """
    writer = (df.repartition(1) if single_file else df).write.mode(mode)
    if level:
        writer = writer.option("zlib.compress.level", level)
    writer.json(path, compression=compression)
    return path


def write_partitioned_json(df: DataFrame, path: str, partition_col: str,
                           mode: str = "overwrite", max_records_per_file: int | None = None) -> str:
    """JSON under ``path/<partition_col>=<value>/``. The partition column leaves
    the JSON body and returns on read through partition discovery. An empty
    string gets a folder of its own (``EMPTY_PARTITION``), which
    ``read_partitioned_json`` turns back."""
    if isinstance(df.schema[partition_col].dataType, T.StringType):
        df = df.withColumn(partition_col, F.when(F.col(partition_col) == "", F.lit(EMPTY_PARTITION))
                           .otherwise(F.col(partition_col)))
    writer = df.hint("rebalance", partition_col).write.mode(mode).partitionBy(partition_col)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.json(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Parquet files under ``path``."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    writer.parquet(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def save_table(df: DataFrame, name: str, comment: str | None = None,
               properties: dict[str, str] | None = None, mode: str = "errorifexists",
               fmt: str = "parquet", partition_by: list[str] | None = None,
               bucket_by: list[str] | None = None, buckets: int = 0) -> str:
    """Catalog table with a comment and key/value properties.

    ``bucket_by`` stores rows in ``buckets`` by these columns, sorted by them: scans
    that group, number or join by them need no shuffle. Rows are dealt by the
    same hash first, so that every bucket is one file. ``mode="overwrite"`` drops
    the table before it writes; under readers, refresh with ``publish_view``."""
    spark = df.sparkSession
    if bucket_by:
        df = df.repartition(buckets, *bucket_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    if properties:
        props = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")
    return name


def publish_view(df: DataFrame, name: str, location: str, comment: str | None = None,
                 properties: dict[str, str] | None = None, partition_by: list[str] | None = None) -> str:
    """Refresh a materialized view of the catalog: the rows go to a new folder
    under ``location``, then one statement sets comment, properties and folder.

    Readers see the old rows until that statement, and the old rows stay if the
    write fails; a query that runs on keeps its files. Old folders but the last
    are deleted."""
    spark, location = df.sparkSession, location.rstrip("/")
    path = f"{location}/{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    try:
        write_parquet(df, path, mode="errorifexists", partition_by=partition_by)
    except Exception:
        delete_path(spark, path)
        raise
    columns = ", ".join(f"`{c}`" for c in df.columns)
    note = f" COMMENT '{_quoted(comment)}'" if comment is not None else ""
    props = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note}{f' TBLPROPERTIES ({props})' if props else ''} "
              f"AS SELECT {columns} FROM parquet.`{path}`")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(location).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    whole = sorted(f.getPath().getParent().toString() for f in fs.globStatus(jvm.Path(f"{location}/*/_SUCCESS")) or [])
    for old in whole[:-2]:
        delete_path(spark, old)
    return name


def backup_json_to_parquet(spark: SparkSession, source: str, target: str,
                           schema: T.StructType | None = None) -> str:
    """Copy a JSON extract into a Parquet backup (overwrite)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    reader.json(source).write.mode("overwrite").parquet(target)
    return target


def write_records_json(spark: SparkSession, rows: list, schema: T.StructType, path: str,
                       mode: str = "overwrite") -> str:
    """Literal records -> JSON-lines through Spark (no driver-side file writing)."""
    from strata.sources.literals import records_frame
    return write_json(records_frame(spark, rows, schema), path, mode=mode)
