"""Silver layer: one pure DataFrame -> DataFrame transform for batch and stream.

Narrow (filter + projection): no shuffle at any scale; Catalyst pushes the
admission filter into the Parquet scan where the columns come from files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.categories import decade_category, duration_category, popularity_tier
from strata.functions import quality as Q
from strata.functions.quality import current_year, quality_score
from strata.functions.rules import blank_to, default_outside, null_outside, within

SILVER_COLUMNS = [
    "song_id", "artist_id", "artist_name", "title", "release_year", "album_info",
    "popularity_score", "duration_seconds", "tempo_bpm", "loudness_db", "key_info",
    "time_signature_info", "artist_location", "artist_coordinates", "audio_features",
    "data_quality_score", "decade_category", "duration_category", "popularity_tier",
    "processing_timestamp",
]

# Struct columns and their fields, used to flatten silver for comparisons.
SILVER_STRUCTS = {
    "key_info": ["key_number", "confidence"],
    "time_signature_info": ["signature", "confidence"],
    "artist_coordinates": ["latitude", "longitude"],
    "audio_features": ["fade_in_end", "fade_out_start"],
}


def admission() -> Column:
    """Rows good enough for analysis: ids present, year known, positive duration."""
    return (
        F.col("song_id").isNotNull() & F.col("title").isNotNull()
        & F.col("artist_name").isNotNull()
        & (F.length(F.trim("title")) > 0) & (F.length(F.trim("artist_name")) > 0)
        & F.col("year").isNotNull() & (F.col("duration") > 0)
    )


def identity_columns() -> dict[str, Column]:
    return {
        "song_id": F.col("song_id"),
        "artist_id": F.col("artist_id"),
        "artist_name": F.trim("artist_name"),
        "title": F.trim("title"),
    }


def range_columns(as_of_year: int | None = None) -> dict[str, Column]:
    return {
        "release_year": null_outside("year", Q.FIRST_YEAR, current_year(as_of_year)),
        "duration_seconds": null_outside("duration", Q.MIN_DURATION_SECONDS,
                                         Q.MAX_DURATION_SECONDS, lo_open=True),
        "tempo_bpm": null_outside("tempo", Q.MIN_TEMPO_BPM, Q.MAX_TEMPO_BPM),
        "loudness_db": F.col("loudness"),
    }


def default_columns() -> dict[str, Column]:
    return {
        "album_info": blank_to("release", Q.UNKNOWN_RELEASE),
        "popularity_score": default_outside("song_hotnes", *Q.HOTNESS_RANGE, Q.HOTNESS_DEFAULT),
        "artist_location": blank_to("artist_location", Q.UNKNOWN_LOCATION),
    }


def struct_columns() -> dict[str, Column]:
    coords_ok = within("artist_lat", *Q.LATITUDE_RANGE) & within("artist_long", *Q.LONGITUDE_RANGE)
    null_d = F.lit(None).cast("double")
    duration = F.col("duration")
    return {
        "key_info": F.struct(
            null_outside("key", *Q.KEY_RANGE).alias("key_number"),
            null_outside("key_confidence", *Q.CONFIDENCE_RANGE).alias("confidence")),
        "time_signature_info": F.struct(
            null_outside("time_signature", *Q.TIME_SIGNATURE_RANGE).alias("signature"),
            null_outside("time_signature_confidence", *Q.CONFIDENCE_RANGE).alias("confidence")),
        "artist_coordinates": F.when(
            coords_ok,
            F.struct(F.col("artist_lat").alias("latitude"),
                     F.col("artist_long").alias("longitude")),
        ).otherwise(F.struct(null_d.alias("latitude"), null_d.alias("longitude"))),
        # The fades are bounded by the raw duration (not the cleaned one).
        "audio_features": F.struct(
            F.when((F.col("end_of_fade_in") >= 0) & (F.col("end_of_fade_in") <= duration),
                   F.col("end_of_fade_in")).alias("fade_in_end"),
            F.when((F.col("start_of_fade_out") >= 0) & (F.col("start_of_fade_out") <= duration),
                   F.col("start_of_fade_out")).alias("fade_out_start")),
    }


def category_columns() -> dict[str, Column]:
    return {
        "decade_category": decade_category("year"),
        "duration_category": duration_category("duration"),
        "popularity_tier": popularity_tier("song_hotnes"),
    }


def silver_columns(as_of_year: int | None = None,
                   processed_at: Column | None = None) -> dict[str, Column]:
    cols = {
        **identity_columns(), **range_columns(as_of_year), **default_columns(),
        **struct_columns(), **category_columns(),
        "data_quality_score": quality_score(as_of_year),
        "processing_timestamp": processed_at if processed_at is not None
        else F.current_timestamp(),
    }
    return cols


def silver(bronze: DataFrame, as_of_year: int | None = None,
           processed_at: Column | None = None) -> DataFrame:
    """Cleaned songs (20 columns) from bronze or raw rows."""
    cols = silver_columns(as_of_year, processed_at)
    return bronze.where(admission()).select(*[cols[c].alias(c) for c in SILVER_COLUMNS])


def silver_schema(spark):
    """The silver columns and types (the transform applied to an empty bronze)."""
    from strata.schemas import BRONZE_SCHEMA
    return silver(spark.createDataFrame([], BRONZE_SCHEMA), as_of_year=2000).schema


def flatten(df: DataFrame, structs: dict[str, list[str]] | None = None) -> DataFrame:
    """Replace struct columns by ``<struct>_<field>`` top-level columns."""
    structs = structs or SILVER_STRUCTS
    out = []
    for c in df.columns:
        if c in structs:
            out += [F.col(f"{c}.{f}").alias(f"{c}_{f}") for f in structs[c]]
        else:
            out.append(F.col(c))
    return df.select(*out)


__all__ = ["silver", "flatten", "admission", "SILVER_COLUMNS", "SILVER_STRUCTS",
           "identity_columns", "range_columns", "default_columns", "struct_columns",
           "category_columns"]
