"""Named row expectations and the per-row quality score."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.rules import nonblank, within

# ---------------------------------------------------------------------------
# Bounds of the cleansing rules, expectations and quality score.
# ---------------------------------------------------------------------------
FIRST_YEAR = 1900                  # release years from here to the clock year
MIN_DURATION_SECONDS = 30          # kept durations: (30, 1800] seconds
MAX_DURATION_SECONDS = 1800
MIN_TEMPO_BPM = 40                 # kept tempos: [40, 250]
MAX_TEMPO_BPM = 250
KEY_RANGE = (0, 11)
TIME_SIGNATURE_RANGE = (1, 12)
CONFIDENCE_RANGE = (0, 1)
HOTNESS_RANGE = (0, 1)
HOTNESS_DEFAULT = 0.0
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)
UNKNOWN_RELEASE = "Unknown Release"
UNKNOWN_LOCATION = "Unknown"
SCORE_POINT = "0.2"                # per passed check; five checks
# ---------------------------------------------------------------------------


def current_year(as_of_year: int | None = None) -> Column:
    """The clock year; pinned when ``as_of_year`` is given (tests, replays)."""
    return F.lit(as_of_year) if as_of_year is not None else F.year(F.current_date())


def expectations(as_of_year: int | None = None) -> dict[str, Column]:
    """The six silver expectations, evaluated on silver columns.

    A violation is recorded, the row is kept (warn semantics). A row passes
    only when the predicate is TRUE; NULL results are reported apart.
    """
    this_year = current_year(as_of_year)
    song_id = F.col("song_id")
    tempo = F.col("tempo_bpm")
    return {
        "valid_song_id": song_id.isNotNull() & (F.length(song_id) > 0),
        "valid_title": nonblank("title"),
        "valid_artist": nonblank("artist_name"),
        "valid_year": within("release_year", FIRST_YEAR, this_year),
        "valid_duration": within("duration_seconds", 0, MAX_DURATION_SECONDS, lo_open=True),
        "valid_tempo": tempo.isNull() | within(tempo, MIN_TEMPO_BPM, MAX_TEMPO_BPM),
    }


EXPECTATIONS = ["valid_song_id", "valid_title", "valid_artist", "valid_year",
                "valid_duration", "valid_tempo"]


def quality_score(as_of_year: int | None = None) -> Column:
    """Five checks on the raw row, 0.2 each: a decimal(15,1) in [0, 1]."""
    checks = [
        F.col("song_id").isNotNull() & (F.length("song_id") > 0),
        nonblank("title"),
        nonblank("artist_name"),
        within("year", FIRST_YEAR, current_year(as_of_year)),
        within("duration", 0, MAX_DURATION_SECONDS, lo_open=True),
    ]
    point = F.lit(Decimal(SCORE_POINT))
    parts = [F.when(c, point).otherwise(F.lit(0)) for c in checks]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total
