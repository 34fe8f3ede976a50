"""``row_number() OVER (PARTITION BY g ORDER BY o)`` that survives hot groups.

A window partitioned by ``g`` sends every row of a group to one task; when a
single group holds a third of the data that task holds a third of the data.
Here the rows are range-partitioned on the full sort key instead, at every
size, so a hot group is cut into many tasks:

1. global sort on ``(g, o)``; each row's partition id and position are written
   with it to a table in the shared folder, so both passes below see the same
   layout even if executors are lost and stages recompute;
2. a small table of (partition, group) -> (row count, first position) gets a
   running sum per group (its size is partitions + groups, not rows);
3. each row's number = rows of its group in earlier partitions + its offset
   inside its partition + 1. The join to the small table is a broadcast when
   its size bound is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.semijoin import MAX_BROADCAST_KEYS
from strata.session import scratch_path


def number_within(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[Column],
                  out_col: str = "row_number", max_groups: int | None = None) -> DataFrame:
    """Append ``out_col`` = 1, 2, ... within each ``partition_cols`` group.

    ``order_cols`` should end in a key that is unique within the group (rows
    equal on every key are interchangeable, so any order among them is fine).
    ``max_groups`` is a proven bound on the number of groups; with it the
    per-partition span table is broadcast.
    """
    spark, part = df.sparkSession, list(partition_cols)
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in part], *order_cols)
    positioned = ordered.select("*", F.spark_partition_id().alias("_pid"),
                                F.monotonically_increasing_id().alias("_pos"))
    path = scratch_path(spark, "numbering")
    positioned.write.parquet(path)
    positioned = spark.read.schema(positioned.schema).parquet(path)

    spans = positioned.groupBy("_pid", *part).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("_pid").alias("_s_pid"), *[F.col(c).alias(f"_s_{c}") for c in part],
        "_first", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"))

    # A global sort has at most this many partitions.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if max_groups is not None and width + max_groups <= MAX_BROADCAST_KEYS:
        spans = F.broadcast(spans)

    cond = F.col("_pid") == F.col("_s_pid")
    for c in part:
        cond = cond & positioned[c].eqNullSafe(F.col(f"_s_{c}"))
    # bigint: a hot group can hold more than 2^31 rows at the target scale.
    number = (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("long")
    return positioned.join(spans, cond, "inner").select(*df.columns, number.alias(out_col))
