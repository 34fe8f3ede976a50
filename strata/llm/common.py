"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space (space, tab to carriage return) as a Java / Python character class body.
WHITE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made unlike every column of ``df`` (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_bucket(col: str | Column, n: int) -> Column:
    """crc32 of an id written as text, modulo ``n`` (NULL id: NULL)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.crc32(col.cast("string")) % F.lit(n)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable over a one-element array: however often the body (or a
    lambda inside it) uses the name, the optimizer cannot inline the
    expression there and evaluate it once per array element.
    """
    return F.transform(F.array(value), body)[0]


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, once per Python worker: a later task in it gets the same object.

    Functions sent by value have new globals in every task, so the object hangs
    on a module of its own.
    """
    module = sys.modules.setdefault("strata_kept", types.ModuleType("strata_kept"))
    objects = module.__dict__.setdefault("objects", {})
    if key not in objects:
        objects[key] = make()
    return objects[key]
