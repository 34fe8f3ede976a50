"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from strata.functions.rules import (  # noqa: F401
    blank_to, default_outside, first_match, nonblank, null_outside, within,
)
from strata.functions.categories import (  # noqa: F401
    analysis_period, artist_tier, decade_category, decade_v2, duration_category,
    popularity_tier, significance,
)
from strata.functions.quality import EXPECTATIONS, quality_score, current_year  # noqa: F401
