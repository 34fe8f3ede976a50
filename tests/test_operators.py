"""Generic operators against brute force on small fixtures, including a hot group."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.metrics import Metric, long_metrics
from strata.operators.numbering import number_within
from strata.operators.sample import sample_rows
from strata.operators.semijoin import keep_keys
from strata.operators.topn import top_k, top_n_per_group
from strata.operators.totals import decimal_mean, group_and_total


def skewed(spark, n=20000):
    # Group 0 holds half of the rows (a hot key); the rest spread over 50 groups.
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("g"),
        (F.col("id") * 7919 % 1000).alias("o"),
        F.col("id"),
    ).repartition(16)


def test_number_within_matches_window_on_hot_group(spark):
    df = skewed(spark)
    got = number_within(df, ["g"], [F.col("o"), F.col("id")], out_col="rn")
    w = Window.partitionBy("g").orderBy("o", "id")
    want = df.withColumn("rn", F.row_number().over(w).cast("int"))
    assert got.count() == df.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_number_within_null_group_and_broadcast(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 1)], "g string, o int")
    got = number_within(df, ["g"], [F.col("o")], out_col="rn", max_groups=2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, 1, 1), (None, 3, 2), ("a", 1, 1), ("a", 2, 2)], key=str)


def test_sample_rows_exact(spark):
    from strata.operators.sample import score
    df = spark.range(50000).withColumn("k", F.col("id"))
    rows = [r.id for r in sample_rows(df, 1000, seed=7, row_id=["k"]).collect()]
    assert len(rows) == 1000 and len(set(rows)) == 1000
    # Exactly the 1000 smallest scores: same as the full sort by the same scores.
    full = df.withColumn("_r", score(7, ["k"])).orderBy("_r").limit(1000)
    assert sorted(rows) == sorted(r.id for r in full.collect())
    # Independent of partitioning (scores come from the row's place in its source).
    again = sample_rows(df.repartition(13), 1000, seed=7, row_id=["k"])
    assert sorted(r.id for r in again.collect()) == sorted(rows)
    # Roughly uniform: the sample mean of 0..49999 is near 25000.
    assert abs(sum(rows) / len(rows) - 25000) < 2500
    assert sample_rows(spark.range(10), 1000, seed=1).count() == 10


def test_top_n_per_group_and_top_k(spark):
    df = skewed(spark).groupBy("g").agg(F.count("*").alias("n"), F.max("o").alias("m"))
    df = df.withColumn("bucket", F.col("g") % 3)
    got = top_n_per_group(df, ["bucket"], [F.desc("n"), F.asc("g")], 2, rank_col="r")
    assert got.groupBy("bucket").count().where("count > 2").count() == 0
    assert sorted(r.r for r in got.where("bucket = 0").collect()) == [1, 2]
    assert [r.g for r in top_k(df, [F.desc("n"), F.asc("g")], 1).collect()] == [0]


def test_keep_keys(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 10)
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    assert keep_keys(df, keys, "k", max_rows=2).count() == 20
    assert keep_keys(df, keys, "k").count() == 20


def test_group_and_total_empty_input(spark):
    empty = spark.createDataFrame([], "g string, x decimal(15,1)")
    per_group, total = group_and_total(empty, "g", "level",
                                       {"n": F.count(F.lit(1)), "s": F.sum("x"), "c": F.count("x")})
    assert per_group.count() == 0
    row = total.select("n", decimal_mean("s", "c", empty.schema["x"].dataType).alias("m")).collect()
    assert [tuple(r) for r in row] == [(0, None)]


def test_long_metrics_skips_empty_metric(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0)],
                               "g string, x double, y double")
    out = long_metrics(df, "g", "period", [Metric("mx", "x", min_rows=2), Metric("my", "y", min_rows=1)])
    got = sorted((r.period, r.metric_name, r.metric_value, r.statistical_significance,
                  r.sample_size) for r in out.collect())
    assert got == [("a", "mx", 2.0, "high", 2), ("b", "my", 2.0, "high", 1)]


def test_number_within_empty_and_global(spark):
    empty = spark.createDataFrame([], "g string, o int")
    assert number_within(empty, ["g"], [F.col("o")]).count() == 0
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("o")).repartition(7)
    got = number_within(df, [], [F.col("o")], out_col="rn")
    assert [tuple(r) for r in got.orderBy("o").collect()] == [(i, i + 1) for i in range(5000)]


def test_number_within_hot_and_null_groups(spark):
    df = skewed(spark, 20000)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
    got = number_within(df, ["g"], [F.col("o"), F.col("id")], out_col="rn")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    nulls = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1), ("a", 0)],
                                  "g string, o int")
    got = number_within(nulls, ["g"], [F.col("o")], out_col="rn")
    w = nulls.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert got.exceptAll(w).count() == 0 and w.exceptAll(got).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_sample_draws_repeated_rows_like_any_others(spark, tmp_path_factory, seed):
    """Half of the rows are equal: a fair draw of 1,000 takes about 500 of them."""
    path = str(tmp_path_factory.getbasetemp() / "repeated.parquet")
    if not os.path.exists(path):
        spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v")) \
            .repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    placed = df.select("v", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    for sample in (sample_rows(placed, 1000, seed, row_id=["f", "i"]), sample_rows(df, 1000, seed)):
        rows = sample.collect()
        assert len(rows) == 1000 and 400 <= sum(r.v == -1 for r in rows) <= 600
