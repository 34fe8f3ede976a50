"""Boundary tests of every silver rule, category and quality check on literal rows."""

import math
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions.categories import (
    analysis_period, artist_tier, decade_category, decade_v2, duration_category, popularity_tier,
    significance,
)
from strata.functions.quality import expectations, quality_score
from strata.plans.silver import admission, default_columns, range_columns, silver, struct_columns
from strata.schemas import RAW_SONG_SCHEMA

NAN = float("nan")


def raw_row(**kw):
    base = {f.name: None for f in RAW_SONG_SCHEMA.fields}
    base.update(song_id="S1", title="T", artist_name="A", year=2000, duration=200.0)
    base.update(kw)
    return tuple(base[f.name] for f in RAW_SONG_SCHEMA.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SONG_SCHEMA)


def one_col(spark, expr, values, dtype):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_duration_guard(spark):
    rows = [raw_row(duration=d) for d in [29.9, 30.0, 30.1, 1800.0, 1800.1, NAN]]
    out = [r.duration_seconds for r in
           frame(spark, rows).select(range_columns(2025)["duration_seconds"]
                                     .alias("duration_seconds")).collect()]
    assert out == [None, None, 30.1, 1800.0, None, None]


def test_year_guard_and_clock(spark):
    rows = [raw_row(year=y) for y in [1899, 1900, 2025, 2026, None, 0]]
    out = [r[0] for r in frame(spark, rows).select(range_columns(2025)["release_year"]).collect()]
    assert out == [None, 1900, 2025, None, None, None]


def test_tempo_guard(spark):
    rows = [raw_row(tempo=t) for t in [39.9, 40.0, 250.0, 250.1, None]]
    out = [r[0] for r in frame(spark, rows).select(range_columns()["tempo_bpm"]).collect()]
    assert out == [None, 40.0, 250.0, None, None]


def test_defaults(spark):
    rows = [raw_row(song_hotnes=h, release=r, artist_location=loc) for h, r, loc in [
        (0.5, " X ", " L "), (1.2, "", "   "), (None, None, None), (NAN, "\t", "\tL"),
        (-0.1, "  ", "")]]
    cols = default_columns()
    out = frame(spark, rows).select(cols["popularity_score"], cols["album_info"],
                                    cols["artist_location"]).collect()
    assert [tuple(r) for r in out] == [
        (0.5, "X", "L"), (0.0, "Unknown Release", "Unknown"), (0.0, "Unknown Release", "Unknown"),
        (0.0, "\t", "\tL"), (0.0, "Unknown Release", "Unknown")]


def test_structs(spark):
    rows = [
        raw_row(key=11, key_confidence=1.0, time_signature=12, time_signature_confidence=0.0,
                artist_lat=90.0, artist_long=-180.0, end_of_fade_in=0.0,
                start_of_fade_out=200.0),
        raw_row(key=12, key_confidence=1.1, time_signature=0, time_signature_confidence=-0.1,
                artist_lat=95.0, artist_long=10.0, end_of_fade_in=-1.0,
                start_of_fade_out=200.1),
        raw_row(key=-1, artist_lat=None, artist_long=10.0, duration=NAN, end_of_fade_in=5.0,
                start_of_fade_out=5.0),
    ]
    cols = struct_columns()
    out = frame(spark, rows).select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert tuple(out[0].key_info) == (11, 1.0)
    assert tuple(out[0].time_signature_info) == (12, 0.0)
    assert tuple(out[0].artist_coordinates) == (90.0, -180.0)
    assert tuple(out[0].audio_features) == (0.0, 200.0)
    assert tuple(out[1].key_info) == (None, None)
    assert tuple(out[1].time_signature_info) == (None, None)
    assert tuple(out[1].artist_coordinates) == (None, None)
    assert tuple(out[1].audio_features) == (None, None)
    # NaN sorts above every number: x <= NaN holds, so fades stay.
    assert tuple(out[2].audio_features) == (5.0, 5.0)
    assert out[2].artist_coordinates is not None and tuple(out[2].artist_coordinates) == (None, None)


def test_categories(spark):
    assert one_col(spark, decade_category, [2020, 2019, 1960, 1959, None, 0], "int") == [
        "2020s", "2010s", "1960s", "Classic", "Classic", "Classic"]
    assert one_col(spark, duration_category, [120.0, 120.1, 240.0, 360.0, 600.0, 600.1, NAN, None],
                   "double") == ["Short", "Standard", "Standard", "Long", "Extended", "Epic",
                                 "Epic", "Epic"]
    assert one_col(spark, popularity_tier, [0.8, 0.79, 0.6, 0.4, 0.2, 0.19, NAN, None],
                   "double") == ["Hit", "Popular", "Popular", "Moderate", "Niche", "Underground",
                                 "Hit", "Underground"]
    assert one_col(spark, decade_v2, [2025, 2010, 1960, 1959], "int") == [
        "2010s", "2010s", "1960s", "Before 1960s"]
    assert one_col(spark, analysis_period, [2010, 1980, 1979], "int") == [
        "2010s", "1980s", "Earlier"]
    assert one_col(spark, artist_tier, [0.8, 0.6, 0.4, 0.39], "double") == [
        "Superstar", "Popular", "Emerging", "Underground"]
    assert one_col(spark, lambda c: significance(c, 1000), [999, 1000], "bigint") == [
        "medium", "high"]


def test_quality_score(spark):
    rows = [raw_row(), raw_row(song_id="", title=" ", artist_name=None, year=1899,
                               duration=1800.1),
            raw_row(duration=20.0), raw_row(year=2026)]
    df = frame(spark, rows).select(quality_score(2025).alias("s"))
    assert str(df.schema["s"].dataType) == "DecimalType(15,1)"
    assert [r.s for r in df.collect()] == [Decimal("1.0"), Decimal("0.0"), Decimal("1.0"),
                                           Decimal("0.8")]


def test_admission(spark):
    rows = [raw_row(), raw_row(song_id=None), raw_row(title="  "), raw_row(artist_name=""),
            raw_row(year=None), raw_row(duration=0.0), raw_row(duration=NAN),
            raw_row(song_id="")]
    kept = frame(spark, rows).where(admission()).count()
    assert kept == 3  # the valid row, NaN duration (NaN > 0) and the empty song id


def test_silver_schema(spark):
    df = silver(frame(spark, [raw_row()]), as_of_year=2025)
    assert len(df.columns) == 20
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types["data_quality_score"] == "decimal(15,1)"
    assert types["artist_coordinates"] == "struct<latitude:double,longitude:double>"
    assert types["key_info"] == "struct<key_number:int,confidence:double>"


def test_expectations_three_valued(spark):
    df = spark.createDataFrame(
        [("S", "T", "A", 2000, 100.0, None), ("", "T", "A", None, 1800.0, 39.0)],
        "song_id string, title string, artist_name string, release_year int, "
        "duration_seconds double, tempo_bpm double")
    rules = expectations(2025)
    out = df.select(*[p.alias(n) for n, p in rules.items()]).collect()
    assert tuple(out[0]) == (True, True, True, True, True, True)
    assert tuple(out[1]) == (False, True, True, None, True, False)
    assert not math.isnan(0.0)
