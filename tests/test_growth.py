"""Steps that grew faster than their input, on rows made here."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from strata.operators.sample import sample_rows, score, smallest
from strata.plans import gold
from strata.plans.silver import silver
from strata.registry import pinned_ts
from strata.schemas import RAW_SONG_SCHEMA
from strata.sinks import versions
from strata.sinks.files import write_json
from strata.sources.songs import load_songs
from strata.streaming import compaction, incremental

TABLES = ["album_releases_by_year", "top_artists_by_decade", "top_artists_by_decade_v2"]


def songs(spark, n=4000, seed=5):
    """Raw songs of few artists and albums; NULLs, ties and repeated rows among them."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        row = dict.fromkeys(RAW_SONG_SCHEMA.names)
        row.update(song_id=f"S{k % 3000}", title=f"T{k % 7}", artist_name=f"A{rng.randrange(120)}",
                   release=rng.choice([None, " ", *(f"R{x}" for x in range(6))]), duration=rng.choice([100.0, 900.0]),
                   year=rng.choice([0, 1955, 1969, 1990, 1991, 2012, 2021]), tempo=rng.choice([None, 90.0]),
                   song_hotnes=rng.choice([None, 0.25, 0.5, 0.75]), artist_location=rng.choice([None, "", "X", "Y"]))
        rows.append(tuple(row[c] for c in RAW_SONG_SCHEMA.names))
    return spark.createDataFrame(rows, RAW_SONG_SCHEMA)


def test_a_batch_delivered_again_writes_no_table_again(spark, tmp_dir):
    rows = silver(songs(spark), as_of_year=2025, processed_at=pinned_ts())
    merge = incremental.artist_gold_merger(tmp_dir)
    for epoch, part in enumerate((rows.where("release_year < 1991"), rows.where("release_year >= 1991 OR release_year IS NULL"))):
        merge(part, epoch)
        before = {t: versions.current(spark, f"{tmp_dir}/{t}").number for t in TABLES}
        merge(part, epoch)
        assert {t: versions.current(spark, f"{tmp_dir}/{t}").number for t in TABLES} == before
    for t in TABLES:
        want = gold.GOLD_TABLES[t](rows)
        got = versions.read(spark, f"{tmp_dir}/{t}").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 < want.count(), t


def test_rankings_look_up_albums_of_ranked_artists_only(spark, tmp_dir):
    rows = silver(songs(spark, 9000), as_of_year=2025, processed_at=pinned_ts())
    gold.album_partials(rows).write.parquet(f"{tmp_dir}/p")
    partials = spark.read.parquet(f"{tmp_dir}/p")
    years = gold.artist_years(partials)
    for name, got in gold.artist_tables(years, partials).items():
        want = gold.GOLD_TABLES[name](rows)
        assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
        got.collect()
        # The whole partials are only scanned beside the ranked artists: no exchange carries albums below that join.
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "BroadcastHashJoin" in plan
    # Unnamed decades and artists rank like any other.
    odd = partials.withColumn("decade_category", F.lit(None).cast("string")).withColumn(
        "artist_name", F.when(F.col("artist_name") != "A1", F.col("artist_name")))
    ranked = gold.ranked_artists_of(gold.artist_years(odd), odd, F.col("decade_category"), top_n=200)
    assert ranked.count() == 120 and ranked.where("artist_name IS NULL AND decade IS NULL").count() == 1


def test_landed_and_extracted_json_is_compressed(spark, tmp_dir):
    rows = songs(spark)
    write_json(rows, f"{tmp_dir}/plain")
    write_json(rows, f"{tmp_dir}/small", compression="gzip")
    size = lambda name: sum(spark.read.format("binaryFile").load(f"{tmp_dir}/{name}/*.json*").toPandas().length)
    assert size("small") * 4 < size("plain")
    back = spark.read.schema(RAW_SONG_SCHEMA).json(f"{tmp_dir}/small")
    assert back.exceptAll(rows).count() == 0 and back.count() == rows.count()


def test_a_third_is_chosen_before_rows_are_spread(spark, tmp_dir):
    keys = spark.range(1000).select(*[F.col("id").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")],
                                    F.lit(1).alias("l_linenumber"), F.col("id").cast("double").alias("l_quantity"))
    keys.coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    thirds = [load_songs(spark, tmp_dir, spread=2, part=(k, 3)) for k in range(3)]
    whole = load_songs(spark, tmp_dir)
    together = thirds[0].unionByName(thirds[1]).unionByName(thirds[2])
    assert sorted(t.count() for t in thirds) == [333, 333, 334] and together.columns == whole.columns
    assert together.exceptAll(whole).count() == 0 and whole.exceptAll(together).count() == 0
    plan = thirds[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Filter")          # printed from the top: the filter is below


def test_compaction_moves_no_rows(spark, tmp_dir, monkeypatch):
    written = []
    publish = versions.publish
    monkeypatch.setattr(compaction.V, "publish", lambda df, root, *a, **k: (written.append((root, df)), publish(df, root, *a, **k))[1])
    spark.range(0, 1000, 1, 6).write.parquet(f"{tmp_dir}/out")
    compaction.compact_output(spark, f"{tmp_dir}/out", f"{tmp_dir}/compact")
    rows = next(df for root, df in written if root.endswith("/rows"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    found = compaction.read_output(spark, f"{tmp_dir}/out", f"{tmp_dir}/compact")
    assert len(found.inputFiles()) == 1 and sorted(r.id for r in found.collect()) == list(range(1000))


def test_a_task_keeps_its_smallest_rows_while_it_reads(spark):
    rng = random.Random(4)
    for n, size in ((1, 50), (7, 1000), (100, 30)):
        values = [rng.randrange(-10 ** 6, 10 ** 6) for _ in range(size)]
        batches = [pa.RecordBatch.from_pydict({"v": values[k:k + 13], "s": [str(v) for v in values[k:k + 13]]})
                   for k in range(0, size, 13)]
        got = [r for b in smallest("v", n)(iter(batches)) for r in b.to_pylist()]
        assert sorted(r["v"] for r in got) == sorted(values)[:n] and all(r["s"] == str(r["v"]) for r in got)
    assert list(smallest("v", 3)(iter([]))) == []
    rows = spark.range(0, 20_000, 1, 3).select("id", F.array("id").alias("a"), F.struct(F.lit(None).cast("string").alias("x")).alias("b"))
    drawn = sample_rows(rows, 500, 9, row_id=["id"])
    want = sorted(r.id for r in rows.select("id", score(9, ["id"]).alias("_r")).orderBy("_r").limit(500).collect())
    assert sorted(r.a[0] for r in drawn.collect()) == want
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan[plan.rindex("WindowGroupLimit"):]   # rows are few before the first sort


def test_artists_and_years_are_rolled_up_in_one_shuffle(spark, tmp_dir):
    rows = silver(songs(spark, 6000), as_of_year=2025, processed_at=pinned_ts())
    halves = [gold.artist_partials(rows.where(f"length(song_id) % 2 = {k}")) for k in (0, 1)]
    halves[0].unionByName(halves[1]).write.parquet(f"{tmp_dir}/p")        # made apart: albums come twice
    partials = spark.read.parquet(f"{tmp_dir}/p").withColumn(
        "artist_name", F.when(F.col("artist_name") != "A1", F.col("artist_name"))).withColumn(
        "album_info", F.when(F.col("album_info") != "R1", F.col("album_info")))
    years = gold.artist_years(partials)
    assert years._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    want = partials.groupBy("decade_category", "release_year", "artist_name").agg(
        *[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in gold._YEAR_SUMS],
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.count_distinct("album_info").alias("albums"))
    assert years.exceptAll(want).count() == 0 and want.exceptAll(years).count() == 0 < want.count()
    assert want.where("artist_name IS NULL").count() and partials.where("album_info IS NULL").count()
    # Releases are these rows, rounded: nothing is grouped again.
    years.write.parquet(f"{tmp_dir}/y")
    rolled = spark.read.parquet(f"{tmp_dir}/y")
    releases = gold.releases_table(rolled, gold.score_type(rows))
    assert "Exchange" not in releases._jdf.queryExecution().executedPlan().toString()
    direct = gold.releases_table(gold.merged_partials(partials), gold.score_type(rows)).select(*releases.columns)
    assert releases.dtypes == direct.dtypes
    assert releases.exceptAll(direct).count() == 0 and direct.exceptAll(releases).count() == 0 < direct.count()


def test_the_stream_stores_what_artists_need(spark, tmp_dir):
    rows = silver(songs(spark), as_of_year=2025, processed_at=pinned_ts())
    assert rows.where("release_year IS NULL").count()
    merge, root = incremental.artist_gold_merger(tmp_dir), f"{tmp_dir}/{incremental.PARTIALS}"
    first, second = (rows.where(f"length(song_id) % 2 = {k}") for k in (0, 1))
    incremental.add_batch(first, 0, root, made=gold.album_partials)       # as stored by an earlier version
    before = versions.read(spark, root)
    assert "loud_sum" in before.columns and before.where("release_year IS NULL").count()
    for epoch, part in enumerate((first, second)):                        # the first is delivered again
        merge(part.select(*gold.ARTIST_COLUMNS), epoch)
    stored = versions.read(spark, root)
    assert stored.columns == gold.ARTIST_PARTIALS and stored.where("release_year IS NULL").count() == 0
    for t in TABLES:
        want = gold.GOLD_TABLES[t](rows)
        got = versions.read(spark, f"{tmp_dir}/{t}").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 < want.count(), t


def test_gzip_level_is_kept_by_the_writer(spark, tmp_dir):
    rows = songs(spark)
    for name, level in (("fast", "BEST_SPEED"), ("three", "THREE"), ("default", None)):
        write_json(rows, f"{tmp_dir}/{name}", compression="gzip", level=level)
    size = lambda name: sum(spark.read.format("binaryFile").load(f"{tmp_dir}/{name}/*.json*").toPandas().length)
    assert size("fast") > size("three") > size("default")
    back = spark.read.schema(RAW_SONG_SCHEMA).json(f"{tmp_dir}/three")
    assert back.exceptAll(rows).count() == 0 and back.count() == rows.count()
