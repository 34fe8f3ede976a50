"""Physical plans have the shape the scale design relies on."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.plans.extracts import extract_recent
from strata.sources.songs import load_songs
from tests.conftest import SF_SMALL

Q = E.queries()


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_trends_read_silver_once(spark):
    for name in ["music_trends", "music_trends_v2"]:
        plan = executed(Q[name](spark, SF_SMALL))
        assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_dashboard_total_and_groups_share_one_scan(spark):
    df = Q["quality_dashboard"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "SortAggregate" not in plan


def test_probe_sorts_no_rows(spark):
    plan = executed(Q["source_probe"](spark, SF_SMALL))
    # Only the per-file rows, after their aggregate, are compared as strings.
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_top_n_uses_window_group_limit(spark):
    plan = executed(Q["top_artists_by_decade"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_sample_and_top_k_are_take_ordered(spark):
    assert "TakeOrderedAndProject" in executed(Q["extract_sample"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in executed(Q["top10_artists"](spark, SF_SMALL))


def test_semi_join_is_broadcast(spark):
    songs = load_songs(spark, SF_SMALL)
    from strata.plans.extracts import top_artist_names
    from strata.operators.semijoin import keep_keys
    df = keep_keys(songs, top_artist_names(songs), "artist_name", max_rows=100)
    plan = executed(df)
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    load_songs(spark, SF_SMALL).write.parquet(path)
    df = extract_recent(spark.read.parquet(path), extracted_at=F.current_timestamp())
    plan = executed(df)
    assert "PushedFilters: [IsNotNull(year), GreaterThanOrEqual(year,2000)" in plan
    counts = spark.read.parquet(path).groupBy("year").count()
    assert "ReadSchema: struct<year:int>" in executed(counts)


def test_coverage_names_the_functions_the_queries_call():
    import pathlib
    from strata.plans import gold
    text = (pathlib.Path(__file__).parent.parent / "COVERAGE.md").read_text()
    for row, name in (("AGG-18", "dashboard_table"), ("AGG-19", "trends_table"), ("WIN-2", "ranked_artists")):
        line = next(l for l in text.splitlines() if l.startswith(f"| {row} |"))
        assert f"`plans/gold.{name}`" in line and callable(getattr(gold, name))


def _final(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_extract_stats_reads_the_extract_once(spark, tmp_dir):
    from strata.plans.extracts import extract_complete, extract_stats
    from strata.sources.songs import load_songs
    extract_complete(load_songs(spark, SF_SMALL)).write.parquet(f"{tmp_dir}/x")
    plan = _final(extract_stats(spark.read.parquet(f"{tmp_dir}/x")))
    assert plan.count("FileScan") == 1
    # Rows are combined below the copies that the two distinct counts need.
    assert "Expand" not in plan[plan.rindex("Exchange hashpartitioning(artist_name"):]


def test_sample_starts_no_job_and_reads_once(spark):
    from strata.operators.sample import sample_rows
    from strata.sources.songs import ROW_ID, load_songs
    sc, songs = spark.sparkContext, load_songs(spark, SF_SMALL, with_row_id=True)
    sc.setJobGroup("sample-build", "building a sample")
    try:
        drawn = sample_rows(songs, 100, 7, row_id=ROW_ID)
        assert list(sc.statusTracker().getJobIdsForGroup("sample-build")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    plan = _final(drawn)
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan


def test_bucketed_table_needs_no_shuffle(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from strata.plans.extracts import songs_by_artist
    from strata.sinks.files import save_table
    from strata.sources.files import read_table
    from strata.sources.songs import load_songs
    songs = load_songs(spark, SF_SMALL).select("artist_name", "song_id", "year")
    save_table(songs, "strata_bucketed_test", bucket_by=["artist_name"], buckets=6)
    try:
        table = read_table(spark, "strata_bucketed_test")
        counted = songs_by_artist(table)
        assert counted.count() == songs.select("artist_name").where("artist_name IS NOT NULL").distinct().count()
        numbered = table.withColumn("k", F.row_number().over(Window.partitionBy("artist_name").orderBy("year", "song_id")))
        for df in (counted, numbered):
            assert "Exchange" not in _final(df)
        joined = table.join(read_table(spark, "strata_bucketed_test").select("artist_name").distinct(), "artist_name")
        assert "Exchange hashpartitioning" not in _final(joined.hint("merge"))
    finally:
        spark.sql("DROP TABLE strata_bucketed_test")
