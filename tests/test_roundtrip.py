"""JSON / CSV round trips, partition discovery, literal records, file inventory."""

from pyspark.sql import functions as F

from strata.schemas import ORDER_SCHEMA, RAW_SONG_SCHEMA
from strata.sinks.files import (
    backup_json_to_parquet, save_table, write_json, write_partitioned_json, write_records_json,
)
from strata.sources.files import file_inventory, read_csv, read_json
from strata.sources.songs import load_songs
from tests.conftest import SF_SMALL


def test_songs_json_roundtrip_keeps_null_blank_nan(spark, tmp_dir):
    songs = load_songs(spark, SF_SMALL)
    write_json(songs, f"{tmp_dir}/songs")
    back = read_json(spark, f"{tmp_dir}/songs", schema=RAW_SONG_SCHEMA)
    assert back.exceptAll(songs).count() == 0 and songs.exceptAll(back).count() == 0
    assert back.where(F.isnan("duration")).count() > 0
    assert back.where(F.col("song_id") == "").count() > 0


def test_single_file_extract(spark, tmp_dir):
    songs = load_songs(spark, SF_SMALL)
    write_json(songs, f"{tmp_dir}/one", single_file=True)
    listed = file_inventory(spark, f"{tmp_dir}/one", glob="*.json").collect()
    assert len(listed) == 1


def test_partitioned_json_discovery_and_escaping(spark, tmp_dir):
    df = spark.createDataFrame([("A/C", 1), ("  ", 2), ("B", 3)], "name string, v int")
    write_partitioned_json(df, f"{tmp_dir}/p", "name")
    back = read_json(spark, f"{tmp_dir}/p", schema=df.schema)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    # Partition pruning: a filter on the partition column reads one folder.
    plan = back.where(F.col("name") == "B")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(name" in plan


def test_csv_inferred_types(spark, tmp_dir):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    part.write.option("header", "true").csv(f"{tmp_dir}/csv")
    back = read_csv(spark, f"{tmp_dir}/csv")
    types = dict((f.name, f.dataType.simpleString()) for f in back.schema.fields)
    assert types["p_partkey"] == "int" and types["p_retailprice"] == "double"
    assert back.count() == part.count()


def test_records_to_json_and_backup(spark, tmp_dir):
    rows = [(k, k % 3, "2024-05-01T00:00:00Z", 10.5 * k, "EUR", 1) for k in range(7)]
    write_records_json(spark, rows, ORDER_SCHEMA, f"{tmp_dir}/orders")
    back = read_json(spark, f"{tmp_dir}/orders", schema=ORDER_SCHEMA)
    assert back.count() == 7
    backup_json_to_parquet(spark, f"{tmp_dir}/orders", f"{tmp_dir}/backup", ORDER_SCHEMA)
    assert spark.read.parquet(f"{tmp_dir}/backup").count() == 7


def test_save_table_with_properties(spark):
    df = spark.range(4)
    save_table(df, "strata_status_test", comment="owner's statuses",
               properties={"quality": "bronze", "pipeline.level": "it's raw"})
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES strata_status_test").collect()}
    assert props["quality"] == "bronze" and props["pipeline.level"] == "it's raw"
    info = {r.col_name: r.data_type for r in
            spark.sql("DESCRIBE TABLE EXTENDED strata_status_test").collect()}
    assert info["Comment"] == "owner's statuses"
    spark.sql("DROP TABLE strata_status_test")


def test_gold_published_to_catalog(spark, tmp_dir):
    from strata.plans.silver import silver
    from strata.streaming.layers import refresh_gold
    path = f"{tmp_dir}/silver"
    silver(load_songs(spark, SF_SMALL), as_of_year=2025).write.parquet(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_test_gold")
    out = refresh_gold(spark, path, f"{tmp_dir}/gold", catalog_prefix="strata_test_gold.")
    assert len(out) == 7
    props = {r.key: r.value for r in
             spark.sql("SHOW TBLPROPERTIES strata_test_gold.top_artists_by_decade").collect()}
    assert props["business.purpose"] == "artist_ranking"
    from strata.sources.files import read_table
    assert read_table(spark, "strata_test_gold.data_quality_dashboard").count() >= 1
    spark.sql("DROP DATABASE strata_test_gold CASCADE")
