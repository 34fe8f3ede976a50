"""Releases and artist rankings kept current by the silver stream.

Distinct albums and rankings do not merge as such, their album partials do:
``gold.artist_partials`` of a micro-batch (counts, sums, times, representative
song of every album and known year) are added to a stored table, partitioned by
year, and the gold tables are rebuilt from it for what the batch touched: the
years with new songs, and the decades of those years. The partials of these
years are rolled up to artists and years once a batch, for all tables. Silver is
read once, by the stream. Partitions that a batch does not touch keep their files.

A batch is delivered again after a failure; every stored table notes the batch
that made its version and takes none twice: the partials are not added again,
and only the gold tables that do not have the batch yet are written. Deltas of a year are merged into one when there are
more than ``max_deltas``, so neither files nor reads grow with the number of
batches. All tables are published whole (``sinks.versions``).
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.categories import decade_category, decade_v2
from strata.plans import gold as G
from strata.plans.silver import silver_schema
from strata.sinks import versions as V
from strata.sinks.files import delete_path, write_parquet
from strata.streaming.triggers import triggered

PARTIALS = "_album_partials"
_YEAR = "release_year"


def _year_of(leaf: str) -> int | None:
    value = unquote(V.partition_of(leaf).partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else int(value)


def _merge_deltas(spark: SparkSession, root: str, merged: Callable[[DataFrame], DataFrame], max_deltas: int) -> None:
    """Years of more than ``max_deltas`` folders become one folder each."""
    manifest = V.current(spark, root)
    if manifest is None:
        return
    folders = Counter(map(V.partition_of, manifest.leaves))
    many = [leaf for leaf in manifest.leaves if folders[V.partition_of(leaf)] > max_deltas]
    if many:
        rows = V.read(spark, root, V.Manifest(manifest.number, manifest.schema, manifest.partition_by, many))
        V.publish(merged(rows), root, [_YEAR], V.PARTITIONS, manifest.meta)


def _narrowed(spark: SparkSession, root: str) -> None:
    """Partials stored with all columns of ``gold.album_partials`` keep those of ``gold.artist_partials``."""
    manifest = V.current(spark, root)
    if manifest is not None and set(G.ARTIST_PARTIALS) < set(manifest.schema.names):
        rows = V.read(spark, root, manifest).where(F.col(_YEAR).isNotNull()).select(*G.ARTIST_PARTIALS)
        V.publish(rows, root, [_YEAR], V.ALL, manifest.meta)


def add_batch(batch: DataFrame, epoch: int, root: str, max_deltas: int = 8,
              made: Callable[[DataFrame], DataFrame] = G.artist_partials,
              merged: Callable[[DataFrame], DataFrame] = G.merged_partials) -> V.Manifest:
    """The stored partials with those of micro-batch ``epoch``, added once however often it comes.

    ``made`` aggregates a batch, ``merged`` several of its results into one; both keep the year."""
    spark = batch.sparkSession
    before = V.current(spark, root)
    if before is not None and before.meta["batch"] >= epoch:
        return before
    _merge_deltas(spark, root, merged, max_deltas)
    return V.publish(made(batch), root, [_YEAR], V.APPEND, {"batch": epoch})


def sketch_merger(root: str, max_deltas: int = 8) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that keeps the sketches of distinct releases (``gold.release_sketches``)."""
    def merge(batch: DataFrame, epoch: int) -> None:
        add_batch(batch, epoch, root, max_deltas, G.release_sketches, G.merged_sketches)
    return merge


def _years_to_read(spark: SparkSession, known: list[int], touched: list[int]) -> dict[str, list[int]]:
    """For each ranking, the known years that share a decade with a touched one (a few hundred years)."""
    if not known:
        return {"top_artists_by_decade": [], "top_artists_by_decade_v2": []}
    labels = spark.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, known))).alias("y")).select(
        "y", decade_category("y").alias("top_artists_by_decade"), decade_v2("y").alias("top_artists_by_decade_v2")).collect()
    out = {}
    for name in ("top_artists_by_decade", "top_artists_by_decade_v2"):
        decades = {r[name] for r in labels if r["y"] in touched}
        out[name] = [r["y"] for r in labels if r[name] in decades]
    return out


def artist_gold_merger(gold_root: str, max_deltas: int = 8) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one silver micro-batch into the stored partials and the tables."""
    root = gold_root.rstrip("/")

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        _narrowed(spark, f"{root}/{PARTIALS}")
        stored = add_batch(batch, epoch, f"{root}/{PARTIALS}", max_deltas)
        added = [leaf for leaf in stored.leaves if f"{V.VERSION}={stored.number:012d}-" in leaf]
        touched = sorted({y for y in map(_year_of, added) if y is not None})
        known = sorted({y for y in map(_year_of, stored.leaves) if y is not None})
        years = {"album_releases_by_year": touched, **_years_to_read(spark, known, touched)}
        have = {name: V.current(spark, f"{root}/{name}") for name in years}
        wanted = [name for name in years if have[name] is None
                  or years[name] and have[name].meta.get("batch", -1) < epoch]
        if not wanted:
            return
        # The filters are on the partition column: only these years' folders are read.
        of = lambda df, some: df.where(F.col(_YEAR).isin(some))
        partials = V.read(spark, f"{root}/{PARTIALS}", stored)
        rolled = G.artist_years(of(partials, sorted({y for name in wanted for y in years[name]})))
        work = f"{root}/_artist_years-{uuid.uuid4().hex[:12]}"
        try:
            write_parquet(rolled, work)
            rolled = spark.read.schema(rolled.schema).parquet(work)
            for name in wanted:
                rows = of(rolled, years[name])
                table = (G.releases_table(rows, G.score_type(batch)) if name == "album_releases_by_year"
                         else G.artist_tables(rows, of(partials, years[name]))[name])
                V.publish(table, f"{root}/{name}", G.GOLD_PARTITIONING[name], V.PARTITIONS, {"batch": epoch})
        finally:
            delete_path(spark, work)

    return merge


def stream_artist_gold(spark: SparkSession, silver_path: str, gold_root: str, checkpoint: str,
                       trigger: str = "availableNow", interval: str = "1 minute",
                       max_files_per_trigger: int | None = None, max_deltas: int = 8) -> StreamingQuery:
    """Maintain the releases table and both rankings under ``gold_root`` from the silver stream."""
    source = spark.readStream.schema(silver_schema(spark))
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (source.parquet(silver_path).select(*G.ARTIST_COLUMNS).writeStream
              .foreachBatch(artist_gold_merger(gold_root, max_deltas)).option("checkpointLocation", checkpoint))
    return triggered(writer, trigger, interval).start()
