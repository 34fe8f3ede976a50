"""Literal records (rows known to the caller) as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def records_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """Literal records (tuples or dicts) -> DataFrame with a declared schema."""
    if rows and isinstance(rows[0], dict):
        rows = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(rows, schema)
