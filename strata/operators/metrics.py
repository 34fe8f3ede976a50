"""Several per-group metrics as long rows, computed in one scan.

``SELECT g, 'm1', agg(x1) ... WHERE x1 IS NOT NULL GROUP BY g UNION ALL ...``
reads the input once per branch (Catalyst does not merge the branches). Here
one ``groupBy`` computes every metric with its own filter folded into the
aggregate, and ``inline`` turns the wide row into one row per metric.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.categories import significance


@dataclass
class Metric:
    """One metric: ``finish(avg(column))`` over the rows where ``column`` is not NULL."""
    name: str
    column: str
    finish: Callable[[Column], Column] = lambda c: c
    tags: dict = field(default_factory=dict)
    min_rows: int = 1000


def long_metrics(df: DataFrame, group: Column | str, group_name: str,
                 metrics: Sequence[Metric]) -> DataFrame:
    """Rows ``(group_name, metric_name, metric_value, *tags, statistical_significance,
    sample_size)``; a metric without rows in a group yields no row there."""
    g = F.col(group) if isinstance(group, str) else group
    aggs = []
    for i, m in enumerate(metrics):
        aggs += [m.finish(F.avg(m.column)).alias(f"_v{i}"), F.count(m.column).alias(f"_n{i}")]
    wide = df.groupBy(g.alias(group_name)).agg(*aggs)
    rows = []
    for i, m in enumerate(metrics):
        n = F.col(f"_n{i}")
        rows.append(F.struct(
            F.lit(m.name).alias("metric_name"),
            F.col(f"_v{i}").cast("double").alias("metric_value"),
            *[F.lit(v).alias(k) for k, v in m.tags.items()],
            significance(n, m.min_rows).alias("statistical_significance"),
            n.alias("sample_size"),
        ))
    return wide.select(group_name, F.inline(F.array(*rows))).where(F.col("sample_size") > 0)
