"""Top-N per group and global top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                    n: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group by ``row_number()``.

    ``order_cols`` must end with a unique key so ranks are deterministic.
    The filter on the rank lets Catalyst insert ``WindowGroupLimit`` below the
    shuffle: each task forwards at most ``n`` rows per group, so even a group
    holding most of the input moves only ``n x tasks`` rows.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w).cast("int"))
              .where(F.col(rank_col) <= n))


def top_k(df: DataFrame, order_cols: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (sort + limit -> ``TakeOrderedAndProject``, no full sort)."""
    return df.orderBy(*order_cols).limit(k)
