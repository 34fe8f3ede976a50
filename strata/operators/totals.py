"""A total row plus one row per group, from a single scan.

The input is aggregated once per group (partial + final hash aggregation);
the total is a second, tiny aggregate over those per-group partials rather
than a second scan of the input. Unlike ``GROUPING SETS`` the total row is
present on empty input, as a plain ``count(*)`` query would return it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def group_and_total(df: DataFrame, group: Column | str, group_name: str,
                    partials: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Per-group partial aggregates and their total, from one scan of ``df``.

    Every partial must merge by addition (counts, sums). The per-group table
    (one row per group) stands behind one exchange, which both results reuse.
    Returns ``(per_group, total)``; ``total`` has exactly one row, also on
    empty input.
    """
    g = F.col(group) if isinstance(group, str) else group
    per_group = (df.groupBy(g.alias(group_name))
                   .agg(*[c.alias(k) for k, c in partials.items()]))
    merged = []
    for k in partials:
        dtype = per_group.schema[k].dataType
        total = F.sum(k)
        if isinstance(dtype, T.DecimalType):
            total = total.cast(dtype)
        else:
            total = F.coalesce(total, F.lit(0).cast(dtype)).cast(dtype)
        merged.append(total.alias(k))
    return per_group, per_group.agg(*merged)


def decimal_mean(total: Column | str, count: Column | str, input_type: T.DecimalType) -> Column:
    """``avg`` of a decimal column rebuilt from (sum, count) with Spark's types.

    ``avg(decimal(p,s))`` is ``sum / count`` evaluated as decimal(p+10,s) over
    decimal(20,0) and returned as decimal(p+4, s+4); NULL when count is 0.
    """
    total = F.col(total) if isinstance(total, str) else total
    count = F.col(count) if isinstance(count, str) else count
    p, s = input_type.precision, input_type.scale
    num = total.cast(T.DecimalType(min(38, p + 10), s))
    den = count.cast(T.DecimalType(20, 0))
    return F.when(count > 0, (num / den).cast(T.DecimalType(min(38, p + 4), min(38, s + 4))))
