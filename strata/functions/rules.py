"""Reusable cleansing rules.

Each rule returns a Column built from Spark SQL expressions, so it stays
inside whole-stage code generation and behaves identically in batch and
streaming plans. Comparisons follow Spark semantics: NULL propagates (a NULL
condition selects the ELSE branch) and NaN sorts above every number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def within(c, lo=None, hi=None, lo_open: bool = False, hi_open: bool = False) -> Column:
    """Predicate ``lo <= c <= hi``; either bound may be open or absent."""
    c = _col(c)
    cond = None
    if lo is not None:
        cond = (c > lo) if lo_open else (c >= lo)
    if hi is not None:
        upper = (c < hi) if hi_open else (c <= hi)
        cond = upper if cond is None else (cond & upper)
    if cond is None:
        raise ValueError("within() needs at least one bound")
    return cond


def null_outside(c, lo=None, hi=None, lo_open: bool = False, hi_open: bool = False) -> Column:
    """Keep ``c`` when it lies in the range, else NULL (range guard)."""
    return F.when(within(c, lo, hi, lo_open, hi_open), _col(c))


def default_outside(c, lo, hi, default) -> Column:
    """Keep ``c`` when ``lo <= c <= hi``, else ``default`` (NULL and NaN too)."""
    return F.when(within(c, lo, hi), _col(c)).otherwise(F.lit(default))


def nonblank(c) -> Column:
    """Not NULL and not empty after trimming spaces."""
    c = _col(c)
    return c.isNotNull() & (F.length(F.trim(c)) > 0)


def blank_to(c, label: str) -> Column:
    """Trimmed text, or ``label`` when the value is NULL or blank."""
    c = _col(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(label)).otherwise(F.trim(c))


def first_match(cases: Iterable[tuple[Column, object]], default) -> Column:
    """Chained CASE WHEN: the first true condition wins, else ``default``."""
    expr = None
    for cond, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if expr is None else expr.otherwise(default)


def bands(c, thresholds: Iterable[tuple[object, str]], other: str) -> Column:
    """Label by the first ``c >= threshold`` in the given order, else ``other``."""
    c = _col(c)
    return first_match(((c >= lo, label) for lo, label in thresholds), other)


def upper_bands(c, limits: Iterable[tuple[object, str]], other: str) -> Column:
    """Label by the first ``c <= limit`` in the given order, else ``other``."""
    c = _col(c)
    return first_match(((c <= hi, label) for hi, label in limits), other)
