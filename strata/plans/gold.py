"""Gold layer: seven tables, each defined once over partial aggregates of silver.

``album_partials`` aggregates silver at (decade, year, artist, album) into
counts and sums from which every gold table rolls up; ``decade_partials`` rolls
them up to (decade, year), about a hundred rows, for trends and dashboards. A
single table builds the partials inside its own plan; a refresh writes them
once and builds all seven from that (``gold_layer``); the stateful stream keeps
``decade_partials`` in its state store. The table definitions are the same.

Scale notes
- Partials hold counts, sums and timestamps only, so every large aggregate is
  a partial + final hash aggregation; a hot artist or decade is pre-combined in
  each task before the shuffle. Distinct albums are the album keys themselves.
- Rankings run on (decade, artist) aggregates; the rank filter becomes
  ``WindowGroupLimit`` below the shuffle. The representative song of an artist
  is a minimum that the same aggregates carry: silver is read once, and partial
  tables hold all that a ranking needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.categories import (
    SIGNIFICANCE_MIN_ROWS, SIGNIFICANCE_MIN_ROWS_LOUDNESS, analysis_period, artist_tier, decade_v2,
    significance,
)
from strata.operators.representative import smallest_row
from strata.operators.topn import top_n_per_group
from strata.operators.totals import decimal_mean

# ---------------------------------------------------------------------------
# Labels of the gold tables.
# ---------------------------------------------------------------------------
UNKNOWN_LOCATION = "Unknown Location"
TOTAL_LEVEL = "silver"
HIT_TIER = "Hit"
STANDARD_DURATION = "Standard"
DECADE_2010S = "2010s"
HIGH_QUALITY_MIN = 0.8
MIN_SONGS_PER_YEAR = 2       # album releases: artists with >= 2 songs in the year
MIN_SONGS_RANKED = 3         # rankings: artists with >= 3 songs in the decade
TOP_PER_DECADE = 50
TREND_CATEGORIES = {
    "avg_duration_minutes": "duration_trend",
    "avg_tempo_bpm": "tempo_trend",
    "avg_popularity_score": "popularity_trend",
    "avg_loudness_db": "loudness_trend",
}
TREND_DIRECTIONS = {
    "avg_duration_minutes": "stable",
    "avg_tempo_bpm": "stable",
    "avg_popularity_score": "evolving",
    "avg_loudness_db": "increasing",
}
# ---------------------------------------------------------------------------

# Row keys that make "some row of the group" choices deterministic.
ROW_KEY = ["song_id", "title"]


_MEASURES = {"dur": "duration_seconds", "tempo": "tempo_bpm", "pop": "popularity_score",
             "loud": "loudness_db"}
GRAIN = ["decade_category", "release_year", "artist_name", "album_info"]
ALBUM = ["release_year", "artist_name", "album_info"]
DECADE_GRAIN = ["decade_category", "release_year"]
_COUNTS = ["n", "missing_song_ids", "missing_titles", "missing_artists", "high_quality_records",
           "hit_songs_count", "standard_duration_songs", "songs_2010s", "score_n",
           *[f"{m}_n" for m in _MEASURES]]
_SUMS = ["score_sum", *[f"{m}_sum" for m in _MEASURES]]
_YEAR_SUMS = ["n", "score_sum", "score_n", *[f"{m}_{x}" for m in ("dur", "tempo", "pop") for x in ("sum", "n")]]
#: What of silver the tables of artists read, and the columns of their partials.
ARTIST_COLUMNS = [*GRAIN, *ROW_KEY, "artist_location", "popularity_tier", "data_quality_score", "processing_timestamp",
                  "popularity_score", "duration_seconds", "tempo_bpm"]
ARTIST_PARTIALS = [*GRAIN, *_YEAR_SUMS, "first_ts", "last_ts", "rep"]


def _now(at: Column | None) -> Column:
    return at if at is not None else F.current_timestamp()


def _aggs() -> dict[str, Column]:
    score = F.col("data_quality_score")
    aggs = {
        "n": F.count(F.lit(1)),
        "missing_song_ids": F.count_if(F.col("song_id").isNull()),
        "missing_titles": F.count_if(F.col("title").isNull()),
        "missing_artists": F.count_if(F.col("artist_name").isNull()),
        "high_quality_records": F.count_if(score >= HIGH_QUALITY_MIN),
        "hit_songs_count": F.count_if(F.col("popularity_tier") == HIT_TIER),
        "standard_duration_songs": F.count_if(F.col("duration_category") == STANDARD_DURATION),
        "songs_2010s": F.count_if(F.col("decade_category") == DECADE_2010S),
        "score_sum": F.sum(score), "score_n": F.count(score),
        "first_ts": F.min("processing_timestamp"),
        "last_ts": F.max("processing_timestamp"),
    }
    for short, col in _MEASURES.items():
        aggs |= {f"{short}_sum": F.sum(col), f"{short}_n": F.count(col)}
    return aggs


def partial_aggs() -> list[Column]:
    """Counts, sums and times of silver rows; all merge by addition, minimum or maximum."""
    return [agg.alias(name) for name, agg in _aggs().items()]


#: The row that stands for an artist: smallest by these, in this order.
_REP = [*ROW_KEY, "artist_location", "popularity_tier"]


def _rated() -> Column:
    return F.col("release_year").isNotNull() & F.col("popularity_score").isNotNull()


def album_partials(silver: DataFrame) -> DataFrame:
    """Partials of every album and year, with the representative of its rated songs (``rep``)."""
    return silver.groupBy(*GRAIN).agg(*partial_aggs(), smallest_row(_REP, _rated()).alias("rep"))


def artist_partials(silver: DataFrame) -> DataFrame:
    """The part of ``album_partials`` that releases and rankings read: known years,
    without the counts of trends and dashboards.

    Groups with a representative are sorted: years order a sort by eight bytes, labels of
    decades hardly do, and ``artist_years`` finds the stored rows in the order it sorts by."""
    aggs = _aggs()
    return silver.where(F.col("release_year").isNotNull()).groupBy(*ALBUM, "decade_category").agg(
        *[aggs[c].alias(c) for c in [*_YEAR_SUMS, "first_ts", "last_ts"]],
        smallest_row(_REP, _rated()).alias("rep")).select(*ARTIST_PARTIALS)


def merged_partials(partials: DataFrame) -> DataFrame:
    """One row for each album and year, of album (or artist) partials that were made apart."""
    return partials.groupBy(*ALBUM, "decade_category").agg(
        *[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in [*_COUNTS, *_SUMS] if c in partials.columns],
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
        F.min("rep").alias("rep")).select(*partials.columns)


def artist_albums(silver: DataFrame, decade: Column) -> DataFrame:
    """Rated songs of every (decade, artist, album): what a ranking needs."""
    pop = F.col("popularity_score")
    return silver.where(_rated()).groupBy(decade.alias("decade"), "artist_name", "album_info").agg(
        F.count(F.lit(1)).alias("pop_n"), F.sum(pop).alias("pop_sum"), F.min("release_year").alias("first_year"),
        F.max("release_year").alias("last_year"), smallest_row(_REP).alias("rep"))


def artist_years(partials: DataFrame) -> DataFrame:
    """Album partials (made at once or apart) rolled up to artists and known years, with
    their distinct albums: numbers only, what releases and the order of rankings need.

    One shuffle by artist and year: there an album's rows lie side by side, and the first
    of them is counted, so sums are taken once, not for every album before."""
    known = partials.where(F.col("release_year").isNotNull()).select(*GRAIN, *_YEAR_SUMS, "first_ts", "last_ts")
    album = Window.partitionBy(*ALBUM).orderBy(F.lit(1))
    counted = known.repartition("release_year", "artist_name").withColumn(
        "_first", (F.row_number().over(album) == 1) & F.col("album_info").isNotNull())
    return counted.groupBy("decade_category", "release_year", "artist_name").agg(
        *[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in _YEAR_SUMS],
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.count_if("_first").alias("albums"))


#: log2 of the registers of a sketch, and the relative standard error of its estimate.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def release_sketches(silver: DataFrame) -> DataFrame:
    """Mergeable sketches of the distinct releases of every (year, artist): for streams,
    where the exact count keeps a row for every album."""
    return silver.where(F.col("release_year").isNotNull()).groupBy("release_year", "artist_name").agg(
        F.hll_sketch_agg("album_info", SKETCH_BITS).alias("releases"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch for each (year, artist), of sketches that were made apart."""
    return sketches.groupBy("release_year", "artist_name").agg(
        F.hll_union_agg("releases").alias("releases")).select(*sketches.columns)


def approximate_releases(sketches: DataFrame, by: str | Column) -> DataFrame:
    """Estimated distinct releases by year, artist or any roll-up of them."""
    group = F.col(by) if isinstance(by, str) else by
    return sketches.groupBy(group.alias("group")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("releases")).alias("distinct_releases"))


def decade_partials(partials: DataFrame) -> DataFrame:
    """Album partials rolled up to (decade, year)."""
    return partials.groupBy(*DECADE_GRAIN).agg(
        *[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in [*_COUNTS, *_SUMS]],
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def score_type(silver: DataFrame) -> T.DecimalType:
    dtype = silver.schema["data_quality_score"].dataType
    return dtype if isinstance(dtype, T.DecimalType) else T.DecimalType(15, 1)


def _mean(short: str) -> Column:
    n = F.sum(f"{short}_n")
    return F.when(n > 0, F.sum(f"{short}_sum") / n)


# --- tables over partials -------------------------------------------------------

def releases_table(p: DataFrame, stype: T.DecimalType, min_songs: int = MIN_SONGS_PER_YEAR) -> DataFrame:
    """Releases from album partials, one row for each album and year, or from their ``artist_years``."""
    rows = p.where(F.col("release_year").isNotNull())
    # The decade is a function of the year: one row for each album, or for each artist and year.
    if "albums" not in p.columns:
        rows = rows.groupBy("release_year", "artist_name").agg(
            *[F.sum(c).alias(c) for c in _YEAR_SUMS], F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"), F.count("album_info").alias("albums"))
    mean = lambda m: F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_sum") / F.col(f"{m}_n"))
    return rows.select(
        "release_year", "artist_name", F.col("n").alias("total_songs"),
        F.round(mean("dur") / 60, 2).alias("avg_duration_minutes"),
        F.round(mean("tempo"), 2).alias("avg_tempo"),
        F.round(mean("pop"), 4).alias("avg_song_hotness"),
        F.col("albums").alias("distinct_releases"),
        F.round(decimal_mean("score_sum", "score_n", stype), 3).alias("avg_quality_score"),
        F.col("first_ts").alias("first_song_date"),
        F.col("last_ts").alias("last_song_date")).where(F.col("total_songs") >= min_songs)


def ranked_artists(albums: DataFrame, min_songs: int = MIN_SONGS_RANKED,
                   top_n: int = TOP_PER_DECADE) -> DataFrame:
    """The first ``top_n`` artists of every decade (``albums``: see ``artist_albums``)."""
    agg = albums.groupBy("decade", "artist_name").agg(
        F.sum("pop_n").alias("total_songs"),
        F.count("album_info").alias("total_releases"),
        _mean("pop").alias("_avg_pop"),
        (F.max("last_year") - F.min("first_year") + 1).cast("int").alias("career_span_years"),
        F.min("rep").alias("_rep"))
    return _first_artists(agg, min_songs, top_n)


def _first_artists(agg: DataFrame, min_songs: int, top_n: int) -> DataFrame:
    return top_n_per_group(
        agg.where(F.col("total_songs") >= min_songs), ["decade"],
        [F.desc("total_songs"), F.desc("_avg_pop"), F.asc("artist_name")], top_n, rank_col="artist_rank")


def ranked_artists_of(years: DataFrame, partials: DataFrame, decade: Column, min_songs: int = MIN_SONGS_RANKED,
                      top_n: int = TOP_PER_DECADE) -> DataFrame:
    """``ranked_artists`` from ``artist_years`` and the album partials they came from.

    Only counts, means and names decide the order, so albums and representative songs
    are looked up for the ranked artists alone (``top_n`` a decade: a broadcast)."""
    rated = lambda df: df.where(F.col("release_year").isNotNull() & (F.col("pop_n") > 0))
    first = _first_artists(
        rated(years).groupBy(decade.alias("decade"), "artist_name").agg(
            F.sum("pop_n").alias("total_songs"), _mean("pop").alias("_avg_pop"),
            (F.max("release_year") - F.min("release_year") + 1).cast("int").alias("career_span_years")),
        min_songs, top_n)
    albums = rated(partials).select(decade.alias("_decade"), F.col("artist_name").alias("_artist"), "album_info", "rep")
    same = F.col("_decade").eqNullSafe(F.col("decade")) & F.col("_artist").eqNullSafe(F.col("artist_name"))
    found = albums.join(F.broadcast(first), same)
    return found.groupBy(*first.columns, "album_info").agg(F.min("rep").alias("_rep")).groupBy(*first.columns).agg(
        F.count("album_info").alias("total_releases"), F.min("_rep").alias("_rep"))


def artists_table(ranked: DataFrame, tier_from_mean: bool) -> DataFrame:
    """Ranked artists with place and tier of their representative song
    (``tier_from_mean``: the tier of their mean popularity)."""
    productivity = F.round(
        F.log(F.col("total_songs")) * F.col("_avg_pop") * F.col("career_span_years") / 10.0, 3)
    tier = artist_tier(F.col("_avg_pop")) if tier_from_mean else F.col("_rep.popularity_tier")
    return ranked.select(
        "decade", "artist_name", "artist_rank", "total_songs", "total_releases",
        F.round("_avg_pop", 4).alias("avg_song_hotness"), "career_span_years",
        F.coalesce("_rep.artist_location", F.lit(UNKNOWN_LOCATION)).alias("geographic_info"),
        productivity.alias("productivity_score"), tier.alias("popularity_tier"))


def trends_table(p: DataFrame, period: Column, tag_col: str, tags: dict,
                 min_rows: int = SIGNIFICANCE_MIN_ROWS,
                 min_rows_loudness: int = SIGNIFICANCE_MIN_ROWS_LOUDNESS) -> DataFrame:
    """Long table: one aggregate per period, unpivoted into four metrics."""
    wide = (p.where(F.col("release_year").isNotNull()).groupBy(period.alias("analysis_period"))
             .agg(*[F.sum(f"{m}_{x}").alias(f"{m}_{x}") for m in _MEASURES for x in ("sum", "n")]))
    specs = [("avg_duration_minutes", "dur", lambda c: F.round(c / 60, 2), min_rows),
             ("avg_tempo_bpm", "tempo", lambda c: F.round(c, 2), min_rows),
             ("avg_popularity_score", "pop", lambda c: F.round(c, 4), min_rows),
             ("avg_loudness_db", "loud", lambda c: F.round(c, 2), min_rows_loudness)]
    rows = [F.struct(
        F.lit(name).alias("metric_name"),
        finish(F.col(f"{m}_sum") / F.col(f"{m}_n")).cast("double").alias("metric_value"),
        F.lit(tags[name]).alias(tag_col),
        significance(F.col(f"{m}_n"), least).alias("statistical_significance"),
        F.col(f"{m}_n").alias("sample_size")) for name, m, finish, least in specs]
    return wide.select("analysis_period", F.inline(F.array(*rows))).where(F.col("sample_size") > 0)


def dashboard_table(p: DataFrame, stype: T.DecimalType, updated_at: Column | None = None,
                    edition: int = 1) -> DataFrame:
    """First edition: a 'silver' total row and one row per decade; second: the
    total alone, without category counts. The total is there for empty silver, too."""
    sums = [F.sum("n").alias("total_records"),
            F.sum(F.when(F.col("release_year").isNull(), F.col("n")).otherwise(0)).alias("missing_years")]
    sums += [F.sum(c).alias(c) for c in [*_COUNTS[1:9], "score_sum"]]
    shown = ["total_records", "missing_song_ids", "missing_titles", "missing_artists", "missing_years"]
    more = ["high_quality_records"] + (["hit_songs_count", "standard_duration_songs"] if edition == 1 else [])

    def finish(df: DataFrame, level: Column, songs_2010s: Column) -> DataFrame:
        count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        cols = [level.alias("table_level"), *map(count, shown),
                F.round(decimal_mean("score_sum", "score_n", stype), 3).alias("avg_quality_score"),
                *map(count, more)]
        if edition == 1:
            cols.append(F.coalesce(songs_2010s, F.lit(0).cast("long")).alias("songs_2010s"))
        return df.select(*cols, _now(updated_at).alias("last_updated"))

    total = finish(p.agg(*sums), F.lit(TOTAL_LEVEL), F.col("songs_2010s"))
    if edition == 2:
        return total
    # Unnamed decades are dropped by a count: a filter on the key would move
    # below the partials, and this branch could not share the total's exchange.
    groups = (p.groupBy(F.col("decade_category").alias("_level"))
               .agg(*sums, F.count("decade_category").alias("_named")).where(F.col("_named") > 0))
    # Per-decade rows report the decade's row count under songs_2010s, as published
    # (the greater of the two, so that both branches read the same columns).
    return total.unionByName(finish(groups, F.col("_level"), F.greatest("total_records", "songs_2010s")))


def decade_tables(p: DataFrame, stype: T.DecimalType = T.DecimalType(15, 1),
                  updated_at: Column | None = None, min_rows: int = SIGNIFICANCE_MIN_ROWS,
                  min_rows_loudness: int = SIGNIFICANCE_MIN_ROWS_LOUDNESS) -> dict[str, DataFrame]:
    """The tables that need (decade, year) partials only."""
    least = {"min_rows": min_rows, "min_rows_loudness": min_rows_loudness}
    return {
        "music_trends_analysis": trends_table(
            p, F.col("decade_category"), "trend_category", TREND_CATEGORIES, **least),
        "music_trends_analysis_v2": trends_table(
            p, analysis_period("release_year"), "trend_direction", TREND_DIRECTIONS, **least),
        "data_quality_dashboard": dashboard_table(p, stype, updated_at, 1),
        "data_quality_dashboard_v2": dashboard_table(p, stype, updated_at, 2),
    }


def artist_tables(years: DataFrame, partials: DataFrame) -> dict[str, DataFrame]:
    """Both rankings from album partials and their ``artist_years``."""
    ranked = lambda decade: ranked_artists_of(years, partials, decade)
    return {
        "top_artists_by_decade": artists_table(ranked(F.col("decade_category")), False),
        "top_artists_by_decade_v2": artists_table(ranked(decade_v2("release_year")), True),
    }


def gold_layer(partials: DataFrame, decades: DataFrame, stype: T.DecimalType,
               updated_at: Column | None = None, **least) -> dict[str, DataFrame]:
    """All seven tables from written partials (``album_partials``, ``decade_partials``)."""
    return {
        "album_releases_by_year": releases_table(partials, stype), **artist_tables(artist_years(partials), partials),
        **decade_tables(decades, stype, updated_at, **least),
    }


# --- tables straight from silver ---------------------------------------------------

def album_releases_by_year(silver: DataFrame, min_songs: int = MIN_SONGS_PER_YEAR,
                           ordered: bool = False) -> DataFrame:
    """Per (release_year, artist): song count, averages, distinct albums."""
    out = releases_table(album_partials(silver), score_type(silver), min_songs)
    return out.orderBy(F.desc("release_year"), F.desc("total_songs"), "artist_name") if ordered else out


def top_artists_by_decade(silver: DataFrame, min_songs: int = MIN_SONGS_RANKED,
                          top_n: int = TOP_PER_DECADE) -> DataFrame:
    """Top artists per silver decade; tier = the tier of a representative song."""
    return artists_table(ranked_artists(artist_albums(silver, F.col("decade_category")), min_songs, top_n), False)


def top_artists_by_decade_v2(silver: DataFrame, min_songs: int = MIN_SONGS_RANKED,
                             top_n: int = TOP_PER_DECADE) -> DataFrame:
    """Second edition: decades from release_year (2020s fold into 2010s) and the
    tier derived from the artist's average popularity."""
    return artists_table(ranked_artists(artist_albums(silver, decade_v2("release_year")), min_songs, top_n), True)


def _coarse(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*DECADE_GRAIN).agg(*partial_aggs())


def music_trends(silver: DataFrame, **least) -> DataFrame:
    """Long table (analysis_period, metric_name, metric_value, trend_category,
    statistical_significance, sample_size) per silver decade."""
    return decade_tables(_coarse(silver), **least)["music_trends_analysis"]


def music_trends_v2(silver: DataFrame, **least) -> DataFrame:
    """Second edition: coarse periods and a trend_direction label."""
    return decade_tables(_coarse(silver), **least)["music_trends_analysis_v2"]


def quality_dashboard(silver: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """A 'silver' total row plus one row per decade_category, from one scan
    (both branches read one exchange of the same partials)."""
    return dashboard_table(_coarse(silver), score_type(silver), updated_at, 1)


def quality_dashboard_v2(silver: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """One 'silver' row: totals, missing counts, mean score, high-quality rows."""
    return dashboard_table(_coarse(silver), score_type(silver), updated_at, 2)


# ---------------------------------------------------------------------------
# Table properties of the published layers.
# ---------------------------------------------------------------------------
TABLE_PROPERTIES = {
    "songs_bronze": {"quality": "bronze", "pipeline.level": "raw"},
    "songs_silver": {"quality": "silver", "pipeline.level": "cleaned",
                     "business.focus": "album_releases_analysis"},
    "album_releases_by_year": {"quality": "gold", "business.purpose": "album_analysis"},
    "top_artists_by_decade": {"quality": "gold", "business.purpose": "artist_ranking"},
    "top_artists_by_decade_v2": {"quality": "gold", "business.purpose": "artist_ranking"},
    "music_trends_analysis": {"quality": "gold", "business.purpose": "trend_analysis"},
    "music_trends_analysis_v2": {"quality": "gold", "business.purpose": "trend_analysis"},
    "data_quality_dashboard": {"quality": "gold", "business.purpose": "data_monitoring"},
    "data_quality_dashboard_v2": {"quality": "gold", "business.purpose": "data_monitoring"},
}
TABLE_COMMENTS = {
    "songs_bronze": "Bronze: raw song rows with ingestion time and source file",
    "songs_silver": "Silver: cleaned songs for album release analysis",
    "album_releases_by_year": "Gold: album releases per year and artist",
    "top_artists_by_decade": "Gold: top artists per decade with performance metrics",
    "top_artists_by_decade_v2": "Gold: top artists per decade with performance metrics",
    "music_trends_analysis": "Gold: aggregated music trends",
    "music_trends_analysis_v2": "Gold: aggregated music trends",
    "data_quality_dashboard": "Gold: data quality monitoring",
    "data_quality_dashboard_v2": "Data quality monitoring dashboard",
}
# ---------------------------------------------------------------------------

# Partition columns of the stored gold tables (pruning for per-year/per-decade reads).
GOLD_PARTITIONING = {
    "album_releases_by_year": ["release_year"],
    "top_artists_by_decade": ["decade"],
    "top_artists_by_decade_v2": ["decade"],
}

GOLD_TABLES = {
    "album_releases_by_year": album_releases_by_year,
    "top_artists_by_decade": top_artists_by_decade,
    "top_artists_by_decade_v2": top_artists_by_decade_v2,
    "music_trends_analysis": music_trends,
    "music_trends_analysis_v2": music_trends_v2,
    "data_quality_dashboard": quality_dashboard,
    "data_quality_dashboard_v2": quality_dashboard_v2,
}
