"""Business categories used by the silver and gold layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.rules import bands, upper_bands

# ---------------------------------------------------------------------------
# Labels and bounds of the published tables (must not change).
# Lists are in the order the conditions are tested; the first match wins.
# ---------------------------------------------------------------------------
DECADE_BANDS = [(2020, "2020s"), (2010, "2010s"), (2000, "2000s"), (1990, "1990s"),
                (1980, "1980s"), (1970, "1970s"), (1960, "1960s")]
DECADE_OTHER = "Classic"

DURATION_LIMITS = [(120, "Short"), (240, "Standard"), (360, "Long"), (600, "Extended")]
DURATION_OTHER = "Epic"

POPULARITY_BANDS = [(0.8, "Hit"), (0.6, "Popular"), (0.4, "Moderate"), (0.2, "Niche")]
POPULARITY_OTHER = "Underground"

DECADE_V2_BANDS = [(2010, "2010s"), (2000, "2000s"), (1990, "1990s"), (1980, "1980s"),
                   (1970, "1970s"), (1960, "1960s")]
DECADE_V2_OTHER = "Before 1960s"

PERIOD_BANDS = [(2010, "2010s"), (2000, "2000s"), (1990, "1990s"), (1980, "1980s")]
PERIOD_OTHER = "Earlier"

ARTIST_TIER_BANDS = [(0.8, "Superstar"), (0.6, "Popular"), (0.4, "Emerging")]
ARTIST_TIER_OTHER = "Underground"

SIGNIFICANCE_HIGH = "high"
SIGNIFICANCE_MEDIUM = "medium"
SIGNIFICANCE_MIN_ROWS = 1000
SIGNIFICANCE_MIN_ROWS_LOUDNESS = 500
# ---------------------------------------------------------------------------


def decade_category(year="year") -> Column:
    """Eight decade labels on the raw year (years before 1960 and NULL: 'Classic')."""
    return bands(year, DECADE_BANDS, DECADE_OTHER)


def duration_category(duration="duration") -> Column:
    """Five length classes on the raw duration in seconds."""
    return upper_bands(duration, DURATION_LIMITS, DURATION_OTHER)


def popularity_tier(hotness="song_hotnes") -> Column:
    """Five tiers on the raw hotness."""
    return bands(hotness, POPULARITY_BANDS, POPULARITY_OTHER)


def decade_v2(year="release_year") -> Column:
    """Seven decade labels on the cleaned year; the 2020s fold into '2010s'."""
    return bands(year, DECADE_V2_BANDS, DECADE_V2_OTHER)


def analysis_period(year="release_year") -> Column:
    """Five coarse periods on the cleaned year."""
    return bands(year, PERIOD_BANDS, PERIOD_OTHER)


def artist_tier(avg_popularity) -> Column:
    """Artist tier from the average popularity of the artist's songs."""
    return bands(avg_popularity, ARTIST_TIER_BANDS, ARTIST_TIER_OTHER)


def significance(sample_size, min_rows: int = SIGNIFICANCE_MIN_ROWS) -> Column:
    """'high' when the group holds at least ``min_rows`` rows, else 'medium'."""
    n = F.col(sample_size) if isinstance(sample_size, str) else sample_size
    return F.when(n >= min_rows, F.lit(SIGNIFICANCE_HIGH)).otherwise(F.lit(SIGNIFICANCE_MEDIUM))
