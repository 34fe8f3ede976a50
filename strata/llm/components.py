"""Connected components of a links table, by alternating star contractions.

Every round is two aggregations and two joins over the links; the links are
written to a fresh folder under ``spark.checkpoint.dir`` after each round, so
the plan stays short and a lost executor costs one round at most. Nothing but
a link count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path


def _written(spark: SparkSession, links: DataFrame, round_no: int) -> tuple[DataFrame, tuple]:
    path = scratch_path(spark, f"links-{round_no}")
    links.write.parquet(path)
    back = spark.read.schema(links.schema).parquet(path)
    mark = back.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return back, (mark[0], mark[1])


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(spark: SparkSession, links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Columns ``node, root``: for every node with a link, the smallest node it reaches.

    ``links`` has two columns of one ordered type, each row an undirected link;
    loops and repeats are allowed, rows with a NULL are ignored. No link: no row.
    """
    a, b = links.columns
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    # Every row is (u, v) with u > v; each star keeps that.
    at, mark = _written(spark, start, 0)
    for k in range(1, max_rounds + 1):
        if not mark[0]:
            break
        after, new = _written(spark, _small_star(_large_star(at)), k)
        if new == mark:
            break
        at, mark = after, new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every link joins a node to the root of its component.
    leaves = at.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(leaves.select("root", "root").distinct().toDF("node", "root"))
