"""Extracts of the raw song data and the checks run on them.

Each extract is a DataFrame; writing it is a separate sink call, so the
selection logic can be tested without files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.numbering import number_within
from strata.operators.sample import sample_rows
from strata.operators.semijoin import keep_keys
from strata.operators.topn import top_k
from strata.schemas import SONG_COLUMNS

# ---------------------------------------------------------------------------
# Labels of the extracts and checks.
# ---------------------------------------------------------------------------
SAMPLE_SOURCE_LABEL = "sample_dataset"
SOURCE_LABEL = "Original Parquet"
EXTRACT_LABEL = "Extracted JSON"
RECENT_SINCE = 2000          # the by-year extract keeps songs from this year on
TOP_ARTISTS = 100            # the top-artists extract: 100 artists ...
TOP_ARTISTS_MIN_SONGS = 10   # ... with at least 10 songs
SAMPLE_SIZE = 1000
TOP_REPORT = 10
# ---------------------------------------------------------------------------


def _now(at: Column | None) -> Column:
    return at if at is not None else F.current_timestamp()


def extract_complete(songs: DataFrame, extracted_at: Column | None = None,
                     source_file: Column | None = None) -> DataFrame:
    """Songs with artist, title and id present; 19 columns + extraction time
    (+ ``source_parquet_file`` when a source column is given)."""
    extra = [_now(extracted_at).alias("extraction_timestamp")]
    if source_file is not None:
        extra.append(source_file.alias("source_parquet_file"))
    return (songs.where(F.col("artist_name").isNotNull() & F.col("title").isNotNull()
                        & F.col("song_id").isNotNull())
                 .select(*SONG_COLUMNS, *extra))


def extract_recent(songs: DataFrame, since: int = RECENT_SINCE,
                   extracted_at: Column | None = None) -> DataFrame:
    """Songs from ``since`` on with artist and title present (to be partitioned by year)."""
    return (songs.where(F.col("year").isNotNull() & (F.col("year") >= since)
                        & F.col("artist_name").isNotNull() & F.col("title").isNotNull())
                 .select(*SONG_COLUMNS, _now(extracted_at).alias("extraction_timestamp")))


def top_artist_counts(songs: DataFrame, top_n: int = TOP_ARTISTS,
                      min_songs: int = TOP_ARTISTS_MIN_SONGS) -> DataFrame:
    """``(artist_name, _n)`` of the ``top_n`` artists with most songs (at least
    ``min_songs``); ties by name."""
    counts = (songs.where(F.col("artist_name").isNotNull())
                   .groupBy("artist_name").agg(F.count(F.lit(1)).alias("_n"))
                   .where(F.col("_n") >= min_songs))
    return top_k(counts, [F.desc("_n"), F.asc("artist_name")], top_n)


def top_artist_names(songs: DataFrame, top_n: int = TOP_ARTISTS,
                     min_songs: int = TOP_ARTISTS_MIN_SONGS) -> DataFrame:
    """The ``top_n`` artists with most songs (at least ``min_songs``); ties by name."""
    return top_artist_counts(songs, top_n, min_songs).select("artist_name")


def extract_top_artists(songs: DataFrame, top_n: int = TOP_ARTISTS,
                        min_songs: int = TOP_ARTISTS_MIN_SONGS) -> DataFrame:
    """Songs of the top artists, numbered per artist by year.

    The key set is a top-k, so its size bound (``top_n``) justifies a
    broadcast semi join. Numbering is skew-safe (see ``number_within``).
    Ties on year are broken by every remaining column.
    """
    top = top_artist_counts(songs, top_n, min_songs)
    chosen = keep_keys(songs.select(*SONG_COLUMNS), top, "artist_name", max_rows=top_n)
    order = ["year", "song_id", "title"] + [c for c in SONG_COLUMNS
                                            if c not in ("year", "song_id", "title", "artist_name")]
    return number_within(chosen, ["artist_name"], [F.col(c).asc_nulls_first() for c in order],
                         out_col="song_number_by_artist", max_groups=top_n)


def extract_sample(songs: DataFrame, n: int = SAMPLE_SIZE, seed: int | None = None,
                   extracted_at: Column | None = None, row_id: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` random songs with an id, tagged as the sample dataset
    (``row_id``: columns that tell source rows apart, see ``sample_rows``)."""
    chosen = sample_rows(songs, n, seed, F.col("song_id").isNotNull(), row_id)
    return chosen.select("*", _now(extracted_at).alias("extraction_timestamp"),
                         F.lit(SAMPLE_SOURCE_LABEL).alias("data_source"))


def source_probe(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Availability of a file source: rows, distinct files, first and last file.

    Counted per file first (one row a file and task), so no row is sorted."""
    per_file = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
        F.count(file_col).alias("total_files"),
        F.min(file_col).alias("first_file"),
        F.max(file_col).alias("last_file"),
    )


def reconcile_counts(source: DataFrame, extract: DataFrame,
                     labels: tuple[str, str] = (SOURCE_LABEL, EXTRACT_LABEL)) -> DataFrame:
    """Row counts of a source and of an extract, one row each."""
    def count(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.lit(label).alias("source"), F.count(F.lit(1)).alias("record_count"))
    return count(source, labels[0]).unionByName(count(extract, labels[1]))


def extract_stats(df: DataFrame) -> DataFrame:
    """Seven summary measures of an extract, from one scan.

    Rows are combined to (artist, year) sums and counts first; the two distinct
    counts then expand that table instead of copies of every row."""
    mean = lambda c: F.when(F.sum(f"_{c}_n") > 0, F.sum(f"_{c}") / F.sum(f"_{c}_n"))
    per_year = df.groupBy("artist_name", "year").agg(
        F.count(F.lit(1)).alias("_n"), *[x for c in ("duration", "tempo") for x in (
            F.sum(c).alias(f"_{c}"), F.count(c).alias(f"_{c}_n"))])
    return per_year.agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("total_songs"),
        F.count_distinct("artist_name").alias("unique_artists"),
        F.count_distinct("year").alias("unique_years"),
        F.min("year").alias("earliest_year"), F.max("year").alias("latest_year"),
        mean("duration").alias("avg_duration_seconds"), mean("tempo").alias("avg_tempo"))


def top_artists_report(df: DataFrame, k: int = TOP_REPORT) -> DataFrame:
    """The ``k`` artists with most songs; ties by name."""
    per_artist = (df.where(F.col("artist_name").isNotNull()).groupBy("artist_name").agg(
        F.count(F.lit(1)).alias("song_count"),
        F.avg("song_hotnes").alias("avg_hotness"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    ))
    return top_k(per_artist, [F.desc("song_count"), F.asc("artist_name")], k)


def songs_by_artist(songs: DataFrame) -> DataFrame:
    """Songs, years and the first song of every named artist. Over a table bucketed
    by artist, no step moves a row."""
    return (songs.where(F.col("artist_name").isNotNull()).groupBy("artist_name").agg(
        F.count(F.lit(1)).alias("song_count"), F.count("year").alias("dated_songs"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year")))


def category_histogram(df: DataFrame, column: str, total_col: str = "total",
                       ordered: bool = True) -> DataFrame:
    """Non-NULL count per value of ``column`` (the NULL group counts 0)."""
    out = df.groupBy(column).agg(F.count(column).alias(total_col))
    return out.orderBy(column) if ordered else out
