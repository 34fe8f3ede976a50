"""Deterministic representative row of a group (replaces ``first()``).

``first(col)`` depends on row arrival order, which changes with partitioning
and retries. The smallest row by its key and values is the same every time,
merges by minimum, and is computed in the pass that aggregates the group, so
partial tables can carry it and no group's rows are looked up again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def smallest_row(order_cols: Sequence[str], where: Column | None = None) -> Column:
    """Aggregate: the smallest row by ``order_cols`` (NULLs first) of those that
    pass ``where``, as a struct; NULL if there is none."""
    row = F.struct(*order_cols)
    return F.min(row if where is None else F.when(where, row))
