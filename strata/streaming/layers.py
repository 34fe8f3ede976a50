"""Incremental bronze and silver tables, and recomputed gold tables.

- Bronze: a file stream over the landing folder; each new file is read once
  (the checkpoint records which files were seen), rows get provenance columns.
- Silver: a stream over bronze's output files through the same transform as
  batch; expectation counters ride along as observed metrics. Bronze is a
  file-sink output, so the silver stream lists it through the sink's
  ``_spark_metadata`` log: only committed files are read, never files left by
  failed or in-flight tasks.
- Gold: recomputed from the whole of silver, or kept current by the stream
  (``stream_decade_gold`` here, releases and rankings in ``incremental``). Every
  new version of a table is published whole (``sinks.versions``).

All state lives in checkpoint folders under the caller's target, so a
restarted job (or a lost executor) resumes without repeating or losing files.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata.functions.quality import expectations
from strata.operators.expectations import observe_expectations
from strata.plans.bronze import REJECTED, bronze
from strata.plans import gold as G
from strata.plans.silver import silver, silver_schema
from strata.schemas import BRONZE_SCHEMA, RAW_SONG_SCHEMA
from strata.sinks import versions
from strata.sinks.files import delete_path, publish_view, write_parquet
from strata.streaming.incremental import stream_artist_gold
from strata.streaming.triggers import triggered

SILVER_METRICS = "silver_expectations"
BRONZE_METRICS = "bronze_rejects"


def bronze_stream(spark: SparkSession, source: str, fmt: str = "json", schema=None,
                  multi_line: bool = False, max_files_per_trigger: int | None = None,
                  ingested_at: Column | None = None,
                  archive_dir: str | None = None, options: dict | None = None,
                  max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of new files under ``source`` -> bronze rows.

    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound a micro-batch
    (by file count, or by size when landed files vary). With ``archive_dir``
    processed files are moved out of the landing folder (``cleanSource``), so
    the per-trigger listing stays small however long the stream runs. Other
    file-source options (``latestFirst``, ``maxFileAge``, ...) pass through
    ``options``. A JSON or CSV record that does not parse, or holds a value of
    the wrong type, is kept whole in ``REJECTED`` beside what could be read;
    rows and rejects are observed as BRONZE_METRICS.
    """
    declared = schema or RAW_SONG_SCHEMA
    text = fmt in ("json", "csv")
    read_as = T.StructType([*declared.fields, T.StructField(REJECTED, T.StringType())]) if text else declared
    reader = spark.readStream.schema(read_as).format(fmt)
    if text:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if fmt == "json":
        reader = reader.option("multiLine", str(multi_line).lower())
    elif fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(int(max_bytes_per_trigger)))
    rows = bronze(reader.load(source), ingested_at=ingested_at, schema=declared)
    if not text:
        return rows
    return rows.observe(BRONZE_METRICS, F.count(F.lit(1)).alias("rows"), F.count(REJECTED).alias("rejected"))


def silver_stream(spark: SparkSession, bronze_path: str, as_of_year: int | None = None,
                  processed_at: Column | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of bronze output -> silver rows with observed expectations."""
    reader = spark.readStream.schema(BRONZE_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cleaned = silver(reader.load(bronze_path), as_of_year=as_of_year, processed_at=processed_at)
    return observe_expectations(cleaned, expectations(as_of_year), SILVER_METRICS)


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: str = "availableNow",
                 interval: str = "1 minute", query_name: str | None = None,
                 fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files. ``trigger``: 'availableNow' (drain what is
    there, then stop: the triggered mode) or 'processingTime' (continuous)."""
    writer = (df.writeStream.format(fmt).outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", path))
    if query_name:
        writer = writer.queryName(query_name)
    return triggered(writer, trigger, interval).start()


class ExpectationMonitor(StreamingQueryListener):
    """Accumulate the observed expectation counters of every micro-batch.

    ``recentProgress`` keeps only the last progress reports; a listener sees
    all of them, so totals stay exact on a stream that runs for weeks.
    ``on_violation(query_name, batch_id, {rule: failed})`` is called for a
    batch with failed rows (alerting hook).
    """

    def __init__(self, name: str = SILVER_METRICS, on_violation=None):
        super().__init__()
        self.name = name
        self.on_violation = on_violation
        self.totals: dict[str, int] = {}
        self.ended: set[str] = set()
        self._lock = threading.Condition()

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        metrics = (event.progress.observedMetrics or {}).get(self.name)
        if metrics is None:
            return
        values = {k: int(v or 0) for k, v in metrics.asDict().items()}
        with self._lock:
            for key, value in values.items():
                self.totals[key] = self.totals.get(key, 0) + value
        failed = {k[: -len("__failed")]: v for k, v in values.items()
                  if k.endswith("__failed") and v}
        if failed and self.on_violation is not None:
            self.on_violation(event.progress.name, event.progress.batchId, failed)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        with self._lock:
            self.ended.add(str(event.id))
            self._lock.notify_all()

    def await_totals(self, query: StreamingQuery, seconds: float = 60) -> dict[str, int]:
        """Totals over all batches of a query that has ended (its events arrive later than it ends)."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(query.id) in self.ended, seconds):
                raise TimeoutError("the query's last events did not arrive")
            return dict(self.totals)


def drain_live(queries: list[StreamingQuery]) -> None:
    """Stop continuous streams once everything that had landed is through all of
    them, in their order (each one's output is the next one's source)."""
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()


def refresh_gold(spark: SparkSession, silver_path: str, gold_root: str,
                 tables: list[str] | None = None, catalog_prefix: str | None = None,
                 shared_scan: bool = True, updated_at: Column | None = None) -> dict[str, str]:
    """Recompute the gold tables (or those named in ``tables``) from the silver files
    and publish the new versions.

    ``shared_scan`` (default) aggregates silver once into partials, written
    under ``gold_root`` for the time of the refresh, and builds all tables from
    them (``gold.gold_layer``); otherwise each table aggregates on its own.
    Each table becomes the next version of its folder (``sinks.versions``; read it
    with ``versions.read``), so readers never see half of a refresh. With
    ``catalog_prefix`` (e.g. ``"analytics."``) the tables are published as catalog
    views over their folders instead, with comments and properties.
    """
    current, root = spark.read.parquet(silver_path), gold_root.rstrip("/")
    work, wanted = f"{root}/_partials-{uuid.uuid4().hex[:12]}", list(tables or G.GOLD_TABLES)
    out = {}
    try:
        if shared_scan and len(wanted) > 1:
            partials = G.album_partials(current)
            write_parquet(partials, f"{work}/albums")
            partials = spark.read.schema(partials.schema).parquet(f"{work}/albums")
            decades = G.decade_partials(partials)
            write_parquet(decades, f"{work}/decades")
            decades = spark.read.schema(decades.schema).parquet(f"{work}/decades")
            frames = G.gold_layer(partials, decades, G.score_type(current), updated_at=updated_at)
        else:
            clock = lambda name: {"updated_at": updated_at} if "dashboard" in name else {}
            frames = {name: G.GOLD_TABLES[name](current, **clock(name)) for name in wanted}
        frames = {name: frames[name] for name in wanted}
        for name, frame in frames.items():
            parts = G.GOLD_PARTITIONING.get(name)
            if catalog_prefix is not None:
                out[name] = publish_view(frame, f"{catalog_prefix}{name}", f"{root}/{name}",
                                         comment=G.TABLE_COMMENTS.get(name),
                                         properties=G.TABLE_PROPERTIES.get(name), partition_by=parts)
            else:
                versions.publish(frame, f"{root}/{name}", parts)
                out[name] = f"{root}/{name}"
    finally:
        delete_path(spark, work)
    return out


def stream_decade_gold(spark: SparkSession, silver_path: str, gold_root: str,
                       checkpoint: str, trigger: str = "availableNow",
                       interval: str = "1 minute", updated_at: Column | None = None,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Maintain the decomposable gold tables (trends v1/v2, dashboards v1/v2)
    incrementally from the silver stream.

    A streaming aggregation keeps per-(decade, year) partial sums and counts
    in the state store (about a hundred groups, whatever the data size); in
    complete mode every micro-batch sees all current partials and
    ``foreachBatch`` rewrites the four finished tables from them. Re-running an
    epoch after a failure rewrites the same content. Tables that need distinct
    counts or ``row_number`` are kept by ``incremental.stream_artist_gold``.
    """
    source = spark.readStream.schema(silver_schema(spark))
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    running = source.parquet(silver_path).groupBy(*G.DECADE_GRAIN).agg(*G.partial_aggs())
    root = gold_root.rstrip("/")

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()                    # about a hundred rows, read by four tables
        try:
            for name, table in G.decade_tables(batch, updated_at=updated_at).items():
                versions.publish(table, f"{root}/{name}")
        finally:
            batch.unpersist()

    writer = (running.writeStream.outputMode("complete").foreachBatch(publish)
                     .option("checkpointLocation", checkpoint))
    return triggered(writer, trigger, interval).start()


def run_medallion(spark: SparkSession, source: str, target: str, fmt: str = "json",
                  as_of_year: int | None = None, trigger: str = "availableNow",
                  max_files_per_trigger: int | None = None, refresh: bool = True,
                  processed_at: Column | None = None,
                  max_bytes_per_trigger: int | None = None,
                  incremental_gold: bool = False, interval: str = "1 minute") -> dict:
    """Land -> bronze -> silver (streams) -> gold (recompute), under ``target``.

    With ``availableNow`` each stream drains what has landed and stops, in
    order; with ``processingTime`` the streams keep running and the caller
    refreshes gold on its own schedule. ``max_files_per_trigger`` limits the
    micro-batches of every stream, ``max_bytes_per_trigger`` those of the
    landing (bronze) stream by size. ``incremental_gold`` also runs
    ``stream_decade_gold`` and ``stream_artist_gold`` over silver (into ``gold/``),
    which keep all gold tables current, in continuous mode too. ``expectations`` and
    ``rejects`` in the result count every batch of the run.
    """
    root = target.rstrip("/")
    paths = {"bronze": f"{root}/bronze", "silver": f"{root}/silver", "gold": f"{root}/gold"}
    drain = trigger == "availableNow"
    monitors = {"rejects": ExpectationMonitor(BRONZE_METRICS), "expectations": ExpectationMonitor()}
    for monitor in monitors.values() if drain else ():
        spark.streams.addListener(monitor)
    result: dict = {"paths": paths, "queries": []}
    try:
        bronze_q = start_append(
            bronze_stream(spark, source, fmt=fmt, max_files_per_trigger=max_files_per_trigger,
                          max_bytes_per_trigger=max_bytes_per_trigger),
            paths["bronze"], f"{root}/_checkpoints/bronze", trigger=trigger, interval=interval)
        if drain:
            bronze_q.awaitTermination()
        silver_q = start_append(
            silver_stream(spark, paths["bronze"], as_of_year=as_of_year, processed_at=processed_at,
                          max_files_per_trigger=max_files_per_trigger),
            paths["silver"], f"{root}/_checkpoints/silver", trigger=trigger, interval=interval)
        result["queries"] += [bronze_q, silver_q]
        if drain:
            silver_q.awaitTermination()
            result["rejects"] = monitors["rejects"].await_totals(bronze_q)
            result["expectations"] = monitors["expectations"].await_totals(silver_q)
    finally:
        for monitor in monitors.values() if drain else ():
            spark.streams.removeListener(monitor)
    if incremental_gold:
        gold_q = stream_decade_gold(spark, paths["silver"], paths["gold"],
                                    f"{root}/_checkpoints/gold", trigger=trigger,
                                    interval=interval, max_files_per_trigger=max_files_per_trigger)
        artists_q = stream_artist_gold(spark, paths["silver"], paths["gold"],
                                       f"{root}/_checkpoints/gold_artists", trigger=trigger,
                                       interval=interval, max_files_per_trigger=max_files_per_trigger)
        result["queries"] += [gold_q, artists_q]
        for query in (gold_q, artists_q) if drain else ():
            query.awaitTermination()
    if drain and refresh:
        result["gold"] = refresh_gold(spark, paths["silver"], paths["gold"])
    return result
