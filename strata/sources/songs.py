"""Songs projection over the driver's ``lineitem`` table.

One song per ``lineitem`` row, derived by a fixed hash ``h`` of the row keys so
every cleansing branch (NULLs, blanks, NaN, out-of-range values, future
years) occurs at every scale. The projection is narrow (no shuffle): at any
size it costs one pass over the four key columns plus ``l_quantity``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.rules import first_match
from strata.sources.files import spread_rows
from strata.schemas import SONG_COLUMNS

#: Columns that tell the rows of a source apart.
ROW_ID = ["_row_file", "_row_index"]



def _nan() -> Column:
    return F.lit(float("nan"))


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _d(c: Column) -> Column:
    return c.cast("double")


def songs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw song rows (19 attributes + ``partial_sequence``/``value``, and the
    source columns that ``lineitem`` has)."""
    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_linenumber"))
    qty = F.col("l_quantity")
    h = ((ok * 31 + pk * 17 + sk * 7 + ln) % 9973).cast("int")

    def m(k: int) -> Column:
        return F.col("_h") % k

    cols = {
        "artist_id": F.concat(F.lit("A"), _s(sk)),
        "artist_lat": first_match([(m(11) == 0, _null("double")), (m(11) == 1, F.lit(95.0))],
                                  _d(m(181)) - 90),
        "artist_long": first_match([(m(19) == 0, F.lit(-200.0))], _d(m(361)) - 180),
        "artist_location": first_match(
            [(m(17) == 0, _null("string")), (m(17) == 1, F.lit("   "))],
            F.concat(F.lit(" City "), _s(sk % 13), F.lit(" "))),
        "artist_name": first_match(
            [(m(89) == 0, _null("string")), (m(89) == 1, F.lit("  "))],
            F.concat(F.lit(" Artist "), _s(sk), F.lit(" "))),
        "duration": first_match([(m(103) == 2, _nan())], qty * 40 - 60),
        "end_of_fade_in": _d(m(40)) * 0.25,
        "key": (m(14) - 1).cast("int"),
        "key_confidence": _d(m(10)) * 0.125,
        "loudness": first_match([(m(13) == 0, _null("double"))], _d(m(240)) * -0.25),
        "release": first_match(
            [(m(23) == 0, _null("string")), (m(23) == 1, F.lit("  "))],
            F.concat(F.lit(" Album "), _s(pk % 40))),
        "song_hotnes": first_match([(m(53) == 0, _null("double")), (m(53) == 1, _nan())],
                                   _d(m(20)) * 0.0625),
        "song_id": first_match(
            [(m(97) == 0, _null("string")), (m(97) == 1, F.lit(""))],
            F.concat(F.lit("S"), _s(ok), F.lit("-"), _s(pk), F.lit("-"), _s(sk),
                     F.lit("-"), _s(ln))),
        "start_of_fade_out": first_match([(m(29) == 0, qty * 40 + 5)], qty * 40 - 65),
        "tempo": first_match([(m(31) == 0, _null("double"))], _d(m(260))),
        "time_signature": (m(14)).cast("int"),
        "time_signature_confidence": _d(m(9)) * 0.125,
        "title": first_match(
            [(m(83) == 0, _null("string")), (m(83) == 1, F.lit(" "))],
            F.concat(F.lit(" Title "), _s(pk))),
        "year": first_match(
            [(m(43) == 0, F.lit(None).cast("int")), (m(43) == 1, F.lit(0))],
            (F.lit(1950) + (ok * 7 + ln * 13) % 85).cast("int")),
    }
    keep = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    extra = [c for c in ("source_file", *ROW_ID) if c in lineitem.columns]
    base = lineitem.select(*keep, *extra).withColumn("_h", h)
    out = [cols[c].alias(c) for c in SONG_COLUMNS]
    out += [_null("string").alias("partial_sequence"), _null("string").alias("value")]
    return base.select(*out, *extra)


def load_songs(spark: SparkSession, sf_dir: str, with_source_file: bool = False,
               with_row_id: bool = False, spread: int | None = None,
               part: tuple[int, int] | None = None) -> DataFrame:
    """Songs for a driver data directory (reads ``lineitem.parquet``).

    ``with_source_file`` adds the file of each row, ``with_row_id`` the columns
    ``ROW_ID`` (file and row number); ``spread`` hash-partitions a source of
    too few splits (off by default: a shuffle of the whole source). ``part``
    ``(k, n)`` are the rows whose number leaves ``k`` when divided by ``n``, chosen
    before they are spread.
    """
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    columns = [F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")]
    if with_source_file:
        columns.append(F.col("_metadata.file_path").alias("source_file"))
    if with_row_id:
        columns += [F.col("_metadata.file_path").alias(ROW_ID[0]), F.col("_metadata.row_index").alias(ROW_ID[1])]
    if part:
        lineitem = lineitem.where(F.col("_metadata.row_index") % part[1] == part[0])
    lineitem = lineitem.select(*columns)
    if spread:
        lineitem = spread_rows(lineitem, spread, ["l_orderkey", "l_linenumber"])
    return songs_from_lineitem(lineitem)
