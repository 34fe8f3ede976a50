"""Declared schemas of the song data and the sample business records."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names and types of the source files.
# ---------------------------------------------------------------------------
# The 19 measured song attributes, in the order the extracts list them.
SONG_COLUMNS = [
    "artist_id", "artist_lat", "artist_long", "artist_location", "artist_name",
    "duration", "end_of_fade_in", "key", "key_confidence", "loudness", "release",
    "song_hotnes", "song_id", "start_of_fade_out", "tempo", "time_signature",
    "time_signature_confidence", "title", "year",
]

_SONG_TYPES = {
    "artist_id": T.StringType(), "artist_lat": T.DoubleType(), "artist_long": T.DoubleType(),
    "artist_location": T.StringType(), "artist_name": T.StringType(), "duration": T.DoubleType(),
    "end_of_fade_in": T.DoubleType(), "key": T.IntegerType(), "key_confidence": T.DoubleType(),
    "loudness": T.DoubleType(), "release": T.StringType(), "song_hotnes": T.DoubleType(),
    "song_id": T.StringType(), "start_of_fade_out": T.DoubleType(), "tempo": T.DoubleType(),
    "time_signature": T.IntegerType(), "time_signature_confidence": T.DoubleType(),
    "title": T.StringType(), "year": T.IntegerType(),
}

# ---------------------------------------------------------------------------

SONG_SCHEMA = T.StructType([T.StructField(c, _SONG_TYPES[c], True) for c in SONG_COLUMNS])

# Raw input rows also carry two free-text columns of the source files.
RAW_SONG_SCHEMA = T.StructType(
    SONG_SCHEMA.fields
    + [T.StructField("partial_sequence", T.StringType(), True),
       T.StructField("value", T.StringType(), True)]
)

BRONZE_SCHEMA = T.StructType(
    RAW_SONG_SCHEMA.fields
    + [T.StructField("ingestion_timestamp", T.TimestampType(), True),
       T.StructField("source_file", T.StringType(), True)]
)

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("created_at", T.StringType()),
])

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("status_id", T.LongType()),
])

STATUS_SCHEMA = T.StructType([
    T.StructField("status_id", T.LongType()),
    T.StructField("status_name", T.StringType()),
    T.StructField("status_description", T.StringType()),
])
