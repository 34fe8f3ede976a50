"""Left semi join (``x IN (subquery)``) with a size-checked broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest key set broadcast on the strength of a proven row bound.
MAX_BROADCAST_KEYS = 100_000


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str] | str,
              max_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` value occurs in ``keys``.

    ``max_rows`` is a proven upper bound on ``keys`` (e.g. the ``k`` of a
    top-k). Only then is the key side broadcast; otherwise the plan is left
    to Catalyst/AQE (sort-merge, or broadcast after runtime statistics).
    """
    on = [on] if isinstance(on, str) else list(on)
    right = keys.select(*on)
    if max_rows is not None and max_rows <= MAX_BROADCAST_KEYS:
        right = F.broadcast(right)
    return df.join(right, on=on, how="left_semi")
