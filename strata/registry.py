"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables in ``sf_dir`` (or files Spark writes
from them) over their full extent. Clock-dependent columns are pinned
(``AS_OF_YEAR``, ``PINNED_TS``) so results are reproducible and comparable
with the SQL oracle in ``strata.oracle_sql``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.quality import expectations, quality_score
from strata.operators.expectations import expectation_report
from strata.operators.numbering import number_within
from strata.operators.semijoin import keep_keys
from strata.operators.topn import top_k, top_n_per_group
from strata.plans import extracts as X
from strata.plans import gold
from strata.plans import silver as S
from strata.plans.bronze import REJECTED, bronze
from strata.plans.silver import flatten, silver, silver_schema
from strata.schemas import RAW_SONG_SCHEMA, SONG_SCHEMA
from strata.session import apply_defaults, scratch_path
from strata.sinks import versions
from strata.sinks.files import (
    backup_json_to_parquet, publish_view, save_table, write_json, write_partitioned_json,
)
from strata.sources.files import (
    base_name, file_inventory, file_totals, preview, read_csv, read_json, read_parquet,
    read_partitioned_json, read_table, register_view,
)
from strata.sources.songs import ROW_ID, load_songs
from strata.streaming.compaction import compact_output, read_output
from strata.streaming.incremental import artist_gold_merger, sketch_merger
from strata.streaming.layers import (
    bronze_stream, drain_live, refresh_gold, run_medallion, start_append, stream_decade_gold,
)

AS_OF_YEAR = 2025
PINNED_TS = _dt.datetime(2025, 1, 1, 0, 0, 0)

EXTRACT_SCHEMA = T.StructType(
    SONG_SCHEMA.fields + [T.StructField("extraction_timestamp", T.TimestampType())])
TOP_ARTISTS_SCHEMA = T.StructType(
    SONG_SCHEMA.fields + [T.StructField("song_number_by_artist", T.LongType())])
SAMPLE_SCHEMA = T.StructType(
    RAW_SONG_SCHEMA.fields + [T.StructField("extraction_timestamp", T.TimestampType()),
                              T.StructField("data_source", T.StringType())])


def pinned_ts():
    return F.lit(PINNED_TS)


#: Session setting: into how many partitions song scans are spread (a shuffle
#: of the whole source, for tables of one split on many cores). Unset: none.
SPREAD = "spark.strata.spreadPartitions"


def _songs(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    apply_defaults(spark)
    spread = spark.conf.get(SPREAD, None)
    return load_songs(spark, sf_dir, spread=int(spread) if spread else None, **columns)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(_songs(spark, sf_dir), as_of_year=AS_OF_YEAR, processed_at=pinned_ts())


def q_silver_songs(spark, sf_dir):
    return flatten(_silver(spark, sf_dir))


def q_album_releases_by_year(spark, sf_dir):
    return gold.album_releases_by_year(_silver(spark, sf_dir))


def q_top_artists_by_decade(spark, sf_dir):
    return gold.top_artists_by_decade(_silver(spark, sf_dir))


def q_top_artists_by_decade_v2(spark, sf_dir):
    return gold.top_artists_by_decade_v2(_silver(spark, sf_dir))


def q_music_trends(spark, sf_dir):
    return gold.music_trends(_silver(spark, sf_dir))


def q_music_trends_v2(spark, sf_dir):
    return gold.music_trends_v2(_silver(spark, sf_dir))


def q_quality_dashboard(spark, sf_dir):
    return gold.quality_dashboard(_silver(spark, sf_dir), updated_at=pinned_ts())


def q_quality_dashboard_v2(spark, sf_dir):
    return gold.quality_dashboard_v2(_silver(spark, sf_dir), updated_at=pinned_ts())


def q_expectation_report(spark, sf_dir):
    return expectation_report(_silver(spark, sf_dir), expectations(AS_OF_YEAR))


def q_quality_score(spark, sf_dir):
    return _songs(spark, sf_dir).select(
        "song_id", "title", quality_score(AS_OF_YEAR).alias("data_quality_score"))


def q_album_releases_ordered(spark, sf_dir):
    """The read-time order of the table as a column."""
    return number_within(q_album_releases_by_year(spark, sf_dir), [],
                         [F.desc("release_year"), F.desc("total_songs"), F.asc("artist_name")], "position")


def q_bronze_songs(spark, sf_dir):
    raw = _songs(spark, sf_dir, with_source_file=True)
    return bronze(raw, ingested_at=pinned_ts(), source_file=base_name(F.col("source_file")))


def _rules(spark, sf_dir, parts):
    cols = {}
    for part in parts:
        cols.update(part())
    return _songs(spark, sf_dir).select("song_id", *[c.alias(n) for n, c in cols.items()
                                                     if n != "song_id"])


def q_silver_identity(spark, sf_dir):
    return _rules(spark, sf_dir, [S.identity_columns])


def q_silver_ranges(spark, sf_dir):
    return _rules(spark, sf_dir, [lambda: S.range_columns(AS_OF_YEAR)])


def q_silver_defaults(spark, sf_dir):
    return _rules(spark, sf_dir, [S.default_columns])


def q_silver_structs(spark, sf_dir):
    return flatten(_rules(spark, sf_dir, [S.struct_columns]))


def q_silver_categories(spark, sf_dir):
    return _rules(spark, sf_dir, [S.category_columns])


# --- extracts -------------------------------------------------------------

def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def q_extract_complete(spark, sf_dir):
    return X.extract_complete(_songs(spark, sf_dir, with_source_file=True), extracted_at=pinned_ts(),
                              source_file=base_name(F.col("source_file")))


def q_extract_2000s(spark, sf_dir):
    return X.extract_recent(_songs(spark, sf_dir), extracted_at=pinned_ts())


def q_extract_2000s_json(spark, sf_dir):
    path = scratch_path(spark, "songs_2000s")
    write_partitioned_json(q_extract_2000s(spark, sf_dir), path, "year")
    return read_json(spark, path, schema=EXTRACT_SCHEMA)


def q_extract_top_artists(spark, sf_dir):
    return X.extract_top_artists(_songs(spark, sf_dir))


def q_extract_top_artists_json(spark, sf_dir):
    path = scratch_path(spark, "top_artists")
    write_partitioned_json(q_extract_top_artists(spark, sf_dir), path, "artist_name")
    return read_partitioned_json(spark, path, "artist_name", TOP_ARTISTS_SCHEMA)


def q_extract_sample(spark, sf_dir):
    return X.extract_sample(_songs(spark, sf_dir, with_row_id=True), n=1000, seed=42,
                            extracted_at=pinned_ts(), row_id=ROW_ID)


def _written_sample(spark, sf_dir):
    path = scratch_path(spark, "sample_1000")
    write_json(q_extract_sample(spark, sf_dir), path)
    return read_json(spark, path, schema=SAMPLE_SCHEMA)


def q_extract_sample_check(spark, sf_dir):
    """What any true sample of 1,000 songs satisfies, read back from its file."""
    return _sample_check(spark, sf_dir, _written_sample(spark, sf_dir))


def q_extract_sample_json_check(spark, sf_dir):
    """The same for a sample of JSON lines, whose rows have no number."""
    path = scratch_path(spark, "songs_json")
    write_json(_songs(spark, sf_dir), path, compression="gzip")
    songs = read_json(spark, path, schema=RAW_SONG_SCHEMA)
    drawn = X.extract_sample(songs, n=1000, seed=42, extracted_at=pinned_ts())
    copy = scratch_path(spark, "sample_of_json")
    write_json(drawn, copy)
    return _sample_check(spark, sf_dir, read_json(spark, copy, schema=SAMPLE_SCHEMA))


def _sample_check(spark, sf_dir, drawn):
    absent = drawn.join(_songs(spark, sf_dir).select("song_id").distinct(), "song_id", "left_anti")
    per_id = drawn.groupBy("song_id").agg(F.count(F.lit(1)).alias("n"), F.min("data_source").alias("label"))
    found = per_id.agg(
        F.sum("n").alias("sample_rows"), F.count_if(F.col("song_id").isNull()).alias("null_ids"),
        (F.count("song_id") >= 0.9 * F.sum("n")).alias("mostly_distinct"),
        F.max("label").alias("data_source"), F.lit(1).alias("k"))
    missing = absent.agg(F.count(F.lit(1)).alias("absent_rows"), F.lit(1).alias("k"))
    return found.join(F.broadcast(missing), "k").drop("k")


def _complete_json(spark, sf_dir):
    path = scratch_path(spark, "songs_complete")
    write_json(q_extract_complete(spark, sf_dir), path, compression="gzip")
    return read_json(spark, path, schema=EXTRACT_SCHEMA)


def q_extract_stats(spark, sf_dir):
    return X.extract_stats(_complete_json(spark, sf_dir))


def q_top10_artists(spark, sf_dir):
    return X.top_artists_report(_complete_json(spark, sf_dir), 10)


def q_reconcile_counts(spark, sf_dir):
    return X.reconcile_counts(_songs(spark, sf_dir), _written_sample(spark, sf_dir))


def q_source_probe(spark, sf_dir):
    rows = read_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet", with_source_file=True)
    return X.source_probe(rows.withColumn("source_file", base_name(F.col("source_file"))))


def q_category_histogram(spark, sf_dir):
    path = scratch_path(spark, "part_csv")
    _table(spark, sf_dir, "part").write.mode("overwrite").option("header", "true").csv(path)
    view = f"part_csv_{uuid.uuid4().hex[:8]}"
    register_view(read_csv(spark, path), view)
    return spark.sql(f"SELECT p_type, count(p_type) AS total FROM {view} "
                     "GROUP BY p_type ORDER BY p_type")


def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "part_csv")
    _table(spark, sf_dir, "part").write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path)


def q_json_roundtrip(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_json")
    write_json(orders, path)
    return read_json(spark, path, schema=orders.schema)


def q_partitioned_json_roundtrip(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders_by_year")
    write_partitioned_json(orders, path, "o_year")
    return read_json(spark, path, schema=orders.schema)


def q_partitioned_blank_roundtrip(spark, sf_dir):
    """Partition values that a folder cannot hold as they are: '' and NULL."""
    status = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).when(
        F.col("o_orderkey") % 3 == 1, F.concat(F.lit("s"), (F.col("o_orderkey") % 5).cast("string")))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"))
    path = scratch_path(spark, "orders_by_status")
    write_partitioned_json(orders, path, "status")
    return read_partitioned_json(spark, path, "status", orders.schema)


def q_file_inventory(spark, sf_dir):
    """Written folders with their files' presence and their rows."""
    orders = _table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders_by_year")
    write_partitioned_json(orders, path, "o_year")
    files = file_totals(file_inventory(spark, path, glob="*.json"))
    rows = read_json(spark, path, schema=orders.schema).groupBy(
        F.concat(F.lit("o_year="), F.col("o_year").cast("string")).alias("folder")).agg(
        F.count(F.lit(1)).alias("row_count"))
    return files.join(rows, "folder").select(
        "folder", (F.col("files") > 0).alias("has_files"), "empty_files", "row_count")


def q_source_preview(spark, sf_dir):
    """The first rows of a scan, checked: how many, and how many are not in the source."""
    source = read_parquet(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    shown = preview(source, 5).select(*keys)
    absent = shown.join(source.select(*keys), keys, "left_anti").agg(
        F.count(F.lit(1)).alias("absent_rows"), F.lit(1).alias("k"))
    return shown.agg(F.count(F.lit(1)).alias("preview_rows"), F.lit(1).alias("k")).join(
        F.broadcast(absent), "k").drop("k")


def q_orders_backup(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    path, copy = scratch_path(spark, "orders_json"), scratch_path(spark, "orders_backup")
    write_json(orders, path)
    backup_json_to_parquet(spark, path, copy, schema=orders.schema)
    return spark.read.parquet(copy)


def q_published_properties(spark, sf_dir):
    """Comment and properties of a published table, read back from the catalog."""
    name = f"strata_dashboard_{uuid.uuid4().hex[:8]}"
    publish_view(gold.quality_dashboard_v2(_silver(spark, sf_dir), updated_at=pinned_ts()), name,
                 scratch_path(spark, "published"), comment="Owner's \\ dashboard",
                 properties={"quality": "gold", "note": "it's 'quoted'"})
    try:
        shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        comment = next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()
                       if r["col_name"] == "Comment")
        total = spark.table(name).first()["total_records"]
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    return spark.createDataFrame(
        [("comment", comment), ("note", shown["note"]), ("quality", shown["quality"]),
         ("total_records", str(total))], "property string, value string")


def q_catalog_artists(spark, sf_dir):
    """Counts and first songs by artist over a catalog table bucketed by artist."""
    name = f"strata_songs_{uuid.uuid4().hex[:8]}"
    save_table(_songs(spark, sf_dir).select("artist_name", "song_id", "title", "year"), name,
               bucket_by=["artist_name"], buckets=shuffle_width(spark))
    return X.songs_by_artist(read_table(spark, name))


def q_multiline_json(spark, sf_dir):
    """A stream over pretty-printed JSON files of a glob: whole records over many lines."""
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "orders-bronze")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    pretty = F.to_json(F.collect_list(F.struct(*orders.columns)), {"pretty": "true"})
    # A file for every 500 orders: a bounded document each.
    parts = orders.groupBy(F.floor(F.col("o_orderkey") / 500).alias("part")).agg(pretty.alias("value"))
    parts.select("value", F.concat(F.lit("day"), (F.col("part") % 7).cast("string")).alias("day")).write.option(
        "maxRecordsPerFile", 1).partitionBy("day").text(landing)
    stream = bronze_stream(spark, f"{landing}/day=day[0-9]/*.txt", schema=orders.schema, multi_line=True)
    start_append(stream, target, f"{target}-checkpoint").awaitTermination()
    return spark.read.parquet(target).select(*orders.columns)


def q_live_medallion(spark, sf_dir):
    """Continuous streams with the clocks running, ended when every landed row is through."""
    landing, began = scratch_path(spark, "landing"), _dt.datetime.now(_dt.timezone.utc)
    write_json(load_songs(spark, sf_dir, spread=3 * _batch_files(spark)), landing, compression="gzip")
    live = run_medallion(spark, landing, scratch_path(spark, "live"), trigger="processingTime", interval="1 second",
                         max_files_per_trigger=_batch_files(spark))
    drain_live(live["queries"])
    ended = _dt.datetime.now(_dt.timezone.utc)
    bronze_rows, rows = (spark.read.parquet(live["paths"][k]) for k in ("bronze", "silver"))
    inside = lambda c: F.min(c).between(F.lit(began), F.lit(ended)) & F.max(c).between(F.lit(began), F.lit(ended))
    # A micro-batch has one time: as many as batches, and one in every file.
    landed = bronze_rows.groupBy("_metadata.file_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ingestion_timestamp").alias("times"),
        F.min("ingestion_timestamp").alias("at")).agg(
        F.sum("n").alias("landed_rows"), F.max("times").alias("times_in_a_file"),
        F.count_distinct("at").alias("batches"), inside("at").alias("landed_in_run"), F.lit(1).alias("k"))
    silver_checks = rows.agg(
        F.count(F.lit(1)).alias("silver_rows"), inside("processing_timestamp").alias("processed_in_run"),
        F.max("release_year").cast("long").alias("latest_year"), F.lit(1).alias("k"))
    return landed.join(F.broadcast(silver_checks), "k").drop("k")


def q_approximate_releases(spark, sf_dir):
    """Distinct releases by year from sketches kept by the stream, each beside the exact count."""
    paths, root = _streamed(spark, sf_dir)["paths"], scratch_path(spark, "sketches")
    source = spark.readStream.schema(silver_schema(spark)).option("maxFilesPerTrigger", _third(spark, paths["silver"]))
    (source.parquet(paths["silver"]).writeStream.foreachBatch(sketch_merger(root, max_deltas=2))
     .trigger(availableNow=True).option("checkpointLocation", f"{root}/_checkpoint").start().awaitTermination())
    near = gold.approximate_releases(versions.read(spark, root), "release_year")
    exact = spark.read.parquet(paths["silver"]).where("release_year IS NOT NULL").groupBy(
        F.col("release_year").alias("group")).agg(F.count_distinct("album_info").alias("exact"))
    error = 3 * gold.SKETCH_ERROR * F.col("exact")
    return exact.join(near, "group", "left").select(
        F.col("group").alias("release_year"), F.col("exact").alias("distinct_releases"),
        (F.abs(F.col("distinct_releases") - F.col("exact")) <= error).alias("within_three_errors"))


def q_semi_join_top_suppliers(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    counts = (li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") >= 10))
    top = top_k(counts, [F.desc("_n"), F.asc("l_suppkey")], 25)
    kept = keep_keys(li, top, "l_suppkey", max_rows=25)
    return number_within(kept, ["l_suppkey"],
                         [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")],
                         out_col="line_number_by_supplier", max_groups=25)


def q_topn_suppliers_per_flag(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_returnflag", "l_suppkey").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("total_quantity"),
        F.round(F.avg("l_quantity"), 2).alias("avg_quantity"))
    return top_n_per_group(agg.where(F.col("line_count") >= 3), ["l_returnflag"],
                           [F.desc("line_count"), F.desc("total_quantity"), F.asc("l_suppkey")],
                           5, rank_col="supplier_rank")


# --- streaming --------------------------------------------------------------

def shuffle_width(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _batch_files(spark) -> int:
    """Files per micro-batch: one for each core."""
    return spark.sparkContext.defaultParallelism


def _third(spark, path: str) -> int:
    """A third of the files that a stream has committed: three micro-batches, however large the files are."""
    return max(1, -(-len(spark.read.schema(silver_schema(spark)).parquet(path).inputFiles()) // 3))


def _streamed(spark, sf_dir) -> dict:
    """Songs land as JSON files; bronze and silver streams take them in three micro-batches."""
    landing, files = scratch_path(spark, "landing"), _batch_files(spark)
    # A gzip file is read by one task: a micro-batch of any size leaves one bronze file a landed one.
    # Level 3 takes two thirds of the default level's time and a fifth more space.
    write_json(load_songs(spark, sf_dir, spread=3 * files), landing, compression="gzip", level="THREE")
    return run_medallion(spark, landing, scratch_path(spark, "medallion"), as_of_year=AS_OF_YEAR,
                         max_files_per_trigger=files, refresh=False, processed_at=pinned_ts())


def q_stream_bronze_silver(spark, sf_dir):
    return flatten(spark.read.parquet(_streamed(spark, sf_dir)["paths"]["silver"]))


def q_stream_compacted(spark, sf_dir):
    """Silver of a stream whose bronze and silver files are compacted between its runs."""
    landing, lake, files = scratch_path(spark, "landing"), scratch_path(spark, "medallion"), _batch_files(spark)
    for third in range(3):
        write_json(load_songs(spark, sf_dir, spread=2 * files, part=(third, 3)), landing, mode="append",
                   compression="gzip")
        paths = run_medallion(spark, landing, lake, as_of_year=AS_OF_YEAR, max_files_per_trigger=files,
                              refresh=False, processed_at=pinned_ts())["paths"]
        if third < 2:                      # the files of the last run are read as the stream left them
            for layer in ("bronze", "silver"):
                compact_output(spark, paths[layer], f"{lake}/compact/{layer}")
    return flatten(read_output(spark, paths["silver"], f"{lake}/compact/silver"))


def q_stream_expectations(spark, sf_dir):
    """Counters of every micro-batch of the silver stream, as its listener saw them."""
    totals = _streamed(spark, sf_dir)["expectations"]
    return spark.createDataFrame(sorted(totals.items()), "counter string, total bigint")


def q_stream_rejects(spark, sf_dir):
    """Landed lines that are cut short or hold a wrong type stay whole in bronze."""
    line = F.to_json(F.struct("o_orderkey", "o_custkey", "o_totalprice"))
    damaged = F.when(F.col("o_orderkey") % 7 == 0, F.expr("substring(line, 1, length(line) - 3)")).when(
        F.col("o_orderkey") % 7 == 1, F.regexp_replace("line", '"o_custkey":', '"o_custkey":"x')).otherwise(F.col("line"))
    damaged = F.when(F.col("o_orderkey") % 7 == 1, F.regexp_replace(damaged, ',"o_totalprice"', '","o_totalprice"')).otherwise(damaged)
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "orders-bronze")
    _table(spark, sf_dir, "orders").withColumn("line", line).select(damaged.alias("value")).write.text(landing)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    start_append(bronze_stream(spark, landing, schema=schema), target, f"{target}-checkpoint").awaitTermination()
    rows = spark.read.parquet(target)
    key = F.regexp_extract(REJECTED, '"o_orderkey":([0-9]+)', 1).cast("long")
    return rows.where(F.col(REJECTED).isNotNull()).select(
        key.alias("o_orderkey"), (~F.col(REJECTED).endswith("}")).alias("cut_short"))


def _decade_gold(table: str):
    def query(spark, sf_dir):
        """Kept by a stateful stream over silver, several micro-batches."""
        paths = _streamed(spark, sf_dir)["paths"]
        gold_root = f"{paths['gold']}_incremental"
        stream_decade_gold(spark, paths["silver"], gold_root, f"{gold_root}/_checkpoint",
                           updated_at=pinned_ts(),
                           max_files_per_trigger=_third(spark, paths["silver"])).awaitTermination()
        return versions.read(spark, f"{gold_root}/{table}")
    return query


def _artist_gold(table: str):
    def query(spark, sf_dir):
        """Kept by the silver stream, batch by batch; every batch is delivered twice, as after a failure."""
        paths, root = _streamed(spark, sf_dir)["paths"], scratch_path(spark, "gold-artists")
        merge = artist_gold_merger(root, max_deltas=2)

        def delivered_twice(batch, epoch):
            merge(batch, epoch)
            merge(batch, epoch)

        source = spark.readStream.schema(silver_schema(spark)).option("maxFilesPerTrigger", _third(spark, paths["silver"]))
        # A batch comes as rows that are read whole: columns are chosen before.
        (source.parquet(paths["silver"]).select(*gold.ARTIST_COLUMNS).writeStream.foreachBatch(delivered_twice)
         .trigger(availableNow=True).option("checkpointLocation", f"{root}/_checkpoint").start().awaitTermination())
        return versions.read(spark, f"{root}/{table}")
    return query


def _refreshed(table: str):
    def query(spark, sf_dir):
        """As deployed: silver files, a refresh of the table, its current version read."""
        root = scratch_path(spark, "lake")
        _silver(spark, sf_dir).write.parquet(f"{root}/silver")
        return versions.read(spark, refresh_gold(spark, f"{root}/silver", f"{root}/gold", tables=[table],
                                                 updated_at=pinned_ts())[table])
    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_songs": q_silver_songs,
    "album_releases_by_year": q_album_releases_by_year,
    "top_artists_by_decade": q_top_artists_by_decade,
    "top_artists_by_decade_v2": q_top_artists_by_decade_v2,
    "music_trends": q_music_trends,
    "music_trends_v2": q_music_trends_v2,
    "quality_dashboard": q_quality_dashboard,
    "quality_dashboard_v2": q_quality_dashboard_v2,
    "expectation_report": q_expectation_report,
    "quality_score": q_quality_score,
    "bronze_songs": q_bronze_songs,
    "silver_identity": q_silver_identity,
    "silver_ranges": q_silver_ranges,
    "silver_defaults": q_silver_defaults,
    "silver_structs": q_silver_structs,
    "silver_categories": q_silver_categories,
    "extract_complete": q_extract_complete,
    "extract_2000s": q_extract_2000s,
    "extract_2000s_json": q_extract_2000s_json,
    "extract_top_artists": q_extract_top_artists,
    "extract_top_artists_json": q_extract_top_artists_json,
    "extract_sample": q_extract_sample,
    "source_probe": q_source_probe,
    "reconcile_counts": q_reconcile_counts,
    "extract_stats": q_extract_stats,
    "top10_artists": q_top10_artists,
    "category_histogram": q_category_histogram,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "partitioned_json_roundtrip": q_partitioned_json_roundtrip,
    "file_inventory": q_file_inventory,
    "partitioned_blank_roundtrip": q_partitioned_blank_roundtrip,
    "orders_backup": q_orders_backup,
    "published_properties": q_published_properties,
    "album_releases_ordered": q_album_releases_ordered,
    "extract_sample_check": q_extract_sample_check,
    "extract_sample_json_check": q_extract_sample_json_check,
    "catalog_artists": q_catalog_artists,
    "multiline_json": q_multiline_json,
    "live_medallion": q_live_medallion,
    "approximate_releases": q_approximate_releases,
    "source_preview": q_source_preview,
    "semi_join_top_suppliers": q_semi_join_top_suppliers,
    "topn_suppliers_per_flag": q_topn_suppliers_per_flag,
    "stream_bronze_silver": q_stream_bronze_silver,
    "stream_compacted": q_stream_compacted,
    "stream_expectations": q_stream_expectations,
    "stream_rejects": q_stream_rejects,
    "stream_music_trends": _decade_gold("music_trends_analysis"),
    "stream_music_trends_v2": _decade_gold("music_trends_analysis_v2"),
    "stream_quality_dashboard": _decade_gold("data_quality_dashboard"),
    "stream_quality_dashboard_v2": _decade_gold("data_quality_dashboard_v2"),
    "stream_album_releases_by_year": _artist_gold("album_releases_by_year"),
    "stream_top_artists_by_decade": _artist_gold("top_artists_by_decade"),
    "stream_top_artists_by_decade_v2": _artist_gold("top_artists_by_decade_v2"),
    **{f"gold_refresh_{name}": _refreshed(name) for name in gold.GOLD_TABLES},
}
