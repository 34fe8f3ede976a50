"""Bronze layer: raw rows on the declared columns plus provenance columns.

The same function serves a batch scan and a streaming file source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import RAW_SONG_SCHEMA

#: Holds a landed record whole when it does not fit the declared schema.
REJECTED = "rejected_record"


def conform_raw(df: DataFrame, schema: T.StructType = RAW_SONG_SCHEMA) -> list[Column]:
    """The declared columns, cast; columns missing from the input are NULL."""
    present = set(df.columns)
    return [
        (F.col(f.name).cast(f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]


def bronze(raw: DataFrame, ingested_at: Column | None = None,
           source_file: Column | None = None,
           schema: T.StructType = RAW_SONG_SCHEMA) -> DataFrame:
    """Declared columns + ``ingestion_timestamp`` + ``source_file``.

    ``schema`` is the declared table (the songs by default; any record type,
    e.g. the sample orders, works the same way). ``source_file`` defaults to
    the hidden ``_metadata.file_path`` of the file scan; ``ingested_at``
    defaults to the (per micro-batch) clock. A column ``REJECTED`` of the
    input (records as landed that did not parse) is kept.
    """
    ts = ingested_at if ingested_at is not None else F.current_timestamp()
    src = source_file if source_file is not None else F.col("_metadata.file_path")
    kept = [F.col(REJECTED)] if REJECTED in raw.columns else []
    return raw.select(*conform_raw(raw, schema), ts.alias("ingestion_timestamp"),
                      src.alias("source_file"), *kept)
