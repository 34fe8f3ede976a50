"""Releases and rankings kept by the stream: exact, idempotent, and only what changed is rewritten."""

import pytest
from pyspark.sql import functions as F

from strata.plans import gold
from strata.plans.silver import silver
from strata.registry import pinned_ts
from strata.sinks import versions
from strata.sources.songs import load_songs
from strata.streaming import incremental
from tests.conftest import SF_SMALL

TABLES = ["album_releases_by_year", "top_artists_by_decade", "top_artists_by_decade_v2"]


@pytest.fixture(scope="module")
def songs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake")) + "/silver"
    silver(load_songs(spark, SF_SMALL), as_of_year=2025, processed_at=pinned_ts()).write.parquet(path)
    return spark.read.parquet(path)


def same(spark, root, rows):
    for name in TABLES:
        want = gold.GOLD_TABLES[name](rows)
        got = versions.read(spark, f"{root}/{name}").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_batches_replays_and_untouched_partitions(spark, songs, tmp_dir):
    merge = incremental.artist_gold_merger(tmp_dir, max_deltas=1)
    old = songs.where("release_year < 1975 AND length(song_id) % 2 = 0")
    new = songs.where("release_year >= 1990 AND release_year < 2000")
    rest = songs.where("release_year < 1975 AND length(song_id) % 2 = 1 AND release_year >= 1970")
    merge(old, 0)
    same(spark, tmp_dir, old)
    before = {t: versions.current(spark, f"{tmp_dir}/{t}").leaves for t in TABLES}
    merge(new, 1)
    stored = versions.current(spark, f"{tmp_dir}/{incremental.PARTIALS}")
    merge(new, 1)                                    # delivered again: nothing is added
    assert versions.current(spark, f"{tmp_dir}/{incremental.PARTIALS}") == stored
    same(spark, tmp_dir, old.unionByName(new))
    for t in TABLES:                                 # the seventies and before keep their files
        assert set(before[t]) <= set(versions.current(spark, f"{tmp_dir}/{t}").leaves)
    merge(rest, 2)                                   # songs for some of the first batch's albums
    merge(songs.where("release_year = 1970").limit(0), 3)
    merge(old.where("release_year = 1972"), 4)       # a third delta of 1972: its deltas are merged
    same(spark, tmp_dir, old.unionByName(new).unionByName(rest).unionByName(old.where("release_year = 1972")))
    folders = [x for x in versions.current(spark, f"{tmp_dir}/{incremental.PARTIALS}").leaves if "=1972/" in x]
    assert len(folders) == 2


def test_only_touched_years_are_read(spark, songs, tmp_dir):
    merge = incremental.artist_gold_merger(tmp_dir)
    merge(songs, 0)
    root = f"{tmp_dir}/{incremental.PARTIALS}"
    read = versions.read(spark, root).where(F.col("release_year").isin([1990, 1991]))
    assert len(read.inputFiles()) and all("release_year=199" in f for f in
                                          read.select("n", F.input_file_name().alias("f")).select("f").distinct().toPandas().f)
    years = incremental._years_to_read(spark, [1955, 1989, 1990, 1999, 2019, 2021], [1990, 2019])
    assert years == {"top_artists_by_decade": [1990, 1999, 2019], "top_artists_by_decade_v2": [1990, 1999, 2019, 2021]}


def test_failure_between_partials_and_tables(spark, songs, tmp_dir, monkeypatch):
    some, more = songs.where("release_year < 1980"), songs.where("release_year >= 1980")
    merge = incremental.artist_gold_merger(tmp_dir)
    merge(some, 0)
    with monkeypatch.context() as m:
        m.setattr(gold, "releases_table", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge(more, 1)
    same(spark, tmp_dir, some)                       # readers still see the tables of batch 0
    merge(more, 1)                                   # the stream delivers the batch again
    same(spark, tmp_dir, songs)


def test_empty_stream_publishes_empty_tables(spark, songs, tmp_dir):
    incremental.artist_gold_merger(tmp_dir)(songs.limit(0), 0)
    for name in TABLES:
        assert versions.read(spark, f"{tmp_dir}/{name}").count() == 0


def test_silver_is_read_once(spark, songs, tmp_dir):
    seen = spark.sparkContext.accumulator(0)
    counted = songs.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(songs.schema)
    n = songs.count()
    incremental.artist_gold_merger(tmp_dir)(counted, 0)
    assert seen.value == n
