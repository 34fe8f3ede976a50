"""One definition per gold table: the refresh over written partials equals the table by itself."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans.gold import GOLD_TABLES
from strata.registry import _silver, pinned_ts
from strata.sinks import versions
from strata.sinks.files import publish_view
from strata.streaming.layers import refresh_gold
from tests.conftest import SF_MED


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    _silver(spark, SF_MED).write.parquet(f"{root}/silver")
    return root, refresh_gold(spark, f"{root}/silver", f"{root}/gold", updated_at=pinned_ts())


@pytest.mark.parametrize("name", sorted(GOLD_TABLES))
def test_refresh_equals_direct(spark, lake, name):
    silver = spark.read.parquet(f"{lake[0]}/silver")
    build = GOLD_TABLES[name]
    direct = build(silver, updated_at=pinned_ts()) if "dashboard" in name else build(silver)
    got = versions.read(spark, lake[1][name]).select(*direct.columns)
    assert got.count() == direct.count() > 0
    assert got.exceptAll(direct).count() == 0 and direct.exceptAll(got).count() == 0


def test_refresh_leaves_nothing_behind(spark, lake):
    root, _ = lake
    for _ in range(2):
        refresh_gold(spark, f"{root}/silver", f"{root}/gold", updated_at=pinned_ts())
    left = [d for d in os.listdir(f"{root}/gold") if not d.startswith(".")]
    assert sorted(left) == sorted(GOLD_TABLES)
    for name in left:                     # the current version and the one before
        assert len([m for m in os.listdir(f"{root}/gold/{name}/manifest") if not m.startswith(".")]) == 2


def test_one_table_refreshed_alone(spark, lake, tmp_dir):
    out = refresh_gold(spark, f"{lake[0]}/silver", tmp_dir, tables=["music_trends_analysis"])
    assert list(out) == ["music_trends_analysis"] == os.listdir(tmp_dir)


def test_view_of_the_catalog_is_switched_whole(spark, tmp_dir):
    read = lambda: (spark.table("strata_view_test").count(), spark.table("strata_view_test").columns)
    publish_view(spark.range(5), "strata_view_test", f"{tmp_dir}/v", comment="it's", properties={"a.b": "c"})
    held = spark.table("strata_view_test")
    assert read() == (5, ["id"])
    with pytest.raises(Exception, match="stop"):
        publish_view(spark.range(9).select(F.raise_error(F.lit("stop")).alias("id")), "strata_view_test", f"{tmp_dir}/v")
    assert read() == (5, ["id"])
    publish_view(spark.range(7).selectExpr("id", "id % 2 AS part"), "strata_view_test", f"{tmp_dir}/v",
                 properties={"a.b": "d"}, partition_by=["part"])
    assert read() == (7, ["id", "part"]) and held.count() == 5
    assert {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES strata_view_test").collect()}["a.b"] == "d"
    for _ in range(3):
        publish_view(spark.range(3), "strata_view_test", f"{tmp_dir}/v")
    assert len([d for d in os.listdir(f"{tmp_dir}/v") if not d.startswith(".")]) == 2
    spark.sql("DROP VIEW strata_view_test")


def test_ranking_reads_silver_once(spark):
    for name in ("top_artists_by_decade", "top_artists_by_decade_v2"):
        df = GOLD_TABLES[name](_silver(spark, SF_MED))
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1 and "Join" not in plan and "WindowGroupLimit" in plan
