"""Cross-table invariants of the gold layer."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.registry import _silver
from tests.conftest import SF_MED

Q = E.queries()


def test_top_n_bounds_and_dense_ranks(spark):
    for name in ["top_artists_by_decade", "top_artists_by_decade_v2"]:
        df = Q[name](spark, SF_MED)
        per = df.groupBy("decade").agg(F.count("*").alias("n"), F.max("artist_rank").alias("mx"),
                                       F.countDistinct("artist_rank").alias("d")).collect()
        for r in per:
            assert r.n <= 50 and r.mx == r.n == r.d
        assert df.where(F.col("total_songs") < 3).count() == 0


def test_trend_sample_sizes_bounded(spark):
    silver_rows = _silver(spark, SF_MED).count()
    for name in ["music_trends", "music_trends_v2"]:
        sizes = Q[name](spark, SF_MED).groupBy("metric_name").agg(F.sum("sample_size").alias("s"))
        assert all(r.s <= silver_rows for r in sizes.collect())


def test_dashboard_groups_add_up(spark):
    df = Q["quality_dashboard"](spark, SF_MED)
    total = df.where(F.col("table_level") == "silver").collect()[0]
    groups = df.where(F.col("table_level") != "silver")
    sums = groups.agg(*[F.sum(c).alias(c) for c in
                        ["total_records", "high_quality_records", "hit_songs_count",
                         "standard_duration_songs"]]).collect()[0]
    for c in sums.asDict():
        assert sums[c] == total[c]
    assert groups.where(F.col("table_level") == "2010s").select("songs_2010s").first()[0] \
        >= total["songs_2010s"] - 0  # per-decade songs_2010s is the decade's row count
    assert total["total_records"] == _silver(spark, SF_MED).count()


def test_expectation_outcomes_partition_rows(spark):
    n = _silver(spark, SF_MED).count()
    for r in Q["expectation_report"](spark, SF_MED).collect():
        assert r.passed + r.failed + r.undetermined == n


def test_fixture_facts(spark):
    s = _silver(spark, SF_MED)
    row = s.agg(F.count("*").alias("n"),
                F.count_if(F.col("release_year").isNull()).alias("no_year"),
                F.count_if(F.col("duration_seconds").isNull()).alias("no_duration"),
                F.count_if(F.col("tempo_bpm").isNull()).alias("no_tempo"),
                F.countDistinct("decade_category").alias("decades"),
                F.countDistinct("duration_category").alias("durations"),
                F.countDistinct("popularity_tier").alias("tiers")).collect()[0]
    assert tuple(row) == (54294, 7002, 5965, 11908, 8, 5, 5)
    scores = {r[0] for r in s.select("data_quality_score").distinct().collect()}
    assert {str(x) for x in scores} >= {"0.4", "0.6", "0.8", "1.0"}


def test_trend_significance_threshold_argument(spark):
    from strata.plans import gold
    s = _silver(spark, SF_MED)
    labels = {r[0] for r in gold.music_trends(s).select("statistical_significance").collect()}
    assert labels == {"high"}
    strict = gold.music_trends(s, min_rows=10**9, min_rows_loudness=10**9)
    assert {r[0] for r in strict.select("statistical_significance").collect()} == {"medium"}
    # The loudness metric has its own, lower threshold.
    mixed = gold.music_trends_v2(s, min_rows=10**9, min_rows_loudness=1)
    by_metric = {(r.metric_name, r.statistical_significance) for r in mixed.collect()}
    assert ("avg_loudness_db", "high") in by_metric and ("avg_tempo_bpm", "medium") in by_metric
