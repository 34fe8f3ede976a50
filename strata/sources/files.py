"""Batch file sources.

Parquet and JSON reads take a declared schema whenever one is known: schema
inference is an extra pass over the data (CSV) or widens/drops columns (JSON),
both of which are wrong at scale.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder value that stands for the empty string, which a folder name cannot hold.
EMPTY_PARTITION = "__EMPTY_STRING__"


def read_parquet(spark: SparkSession, path: str, with_source_file: bool = False) -> DataFrame:
    """Path-addressed Parquet scan; optionally adds the source file of each row."""
    df = spark.read.parquet(path)
    if with_source_file:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def spread_rows(df: DataFrame, partitions: int, unique_key: list[str]) -> DataFrame:
    """Hash-partition a scan on a unique key, for sources of too few splits
    (one large row group is read by one task, and so is all narrow work above).

    A full shuffle, made only where the caller asks for it. The observed row
    count keeps Catalyst from moving later filters back below the exchange
    into the single scan task.
    """
    return df.repartition(partitions, *unique_key).observe(
        f"source_rows_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header row. Without ``schema`` the types are inferred
    (one extra scan); production callers should pass the schema."""
    reader = spark.read.format("csv").option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.load(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              multi_line: bool = False) -> DataFrame:
    """JSON (JSON-lines by default; ``multi_line`` for one document per file)."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows the scan produces (``LIMIT n``, no ordering)."""
    return df.limit(n)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL as a temporary view."""
    df.createOrReplaceTempView(name)
    return df


def file_inventory(spark: SparkSession, path: str, glob: str = "*",
                   recursive: bool = True) -> DataFrame:
    """The files below ``path`` as a DataFrame (path, length, modification time).

    The binary content column is never selected, so files are listed, not read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "length", "modificationTime")
    )


def file_totals(inventory: DataFrame) -> DataFrame:
    """Files per folder of a ``file_inventory``: folder name, files, whether any is empty."""
    folder = F.element_at(F.split("path", "/"), -2)
    return inventory.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") == 0).alias("empty_files"))


def base_name(path: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(path, "/"), -1)


def read_partitioned_json(spark: SparkSession, path: str, partition_col: str,
                          schema: T.StructType) -> DataFrame:
    """What ``write_partitioned_json`` wrote; empty strings of the partition column are kept."""
    df = read_json(spark, path, schema=schema)
    if isinstance(schema[partition_col].dataType, T.StringType):
        df = df.withColumn(partition_col, F.when(F.col(partition_col) != EMPTY_PARTITION, F.col(partition_col))
                           .when(F.col(partition_col) == EMPTY_PARTITION, F.lit("")))
    return df.select(*schema.names)
