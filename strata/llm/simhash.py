"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 9).

A fingerprint's bit is 1 if it is set in over half of the text's shingle
hashes. Two fingerprints within ``max_bits`` have a common variant within half
that distance of each: every distinct fingerprint emits all variants in that
half ball, one shuffle brings equal variants together, and whoever meets there
is linked. A variant's members are themselves a ball, so they are kept as a
bit mask of the flips that lead to them (a fixed-width aggregate), and each is
linked to the smallest of them: as many links as members, never all pairs.

Defined results: NULL or empty text, or text without a word, has fingerprint
zero, which links like any other. Fewer words than a shingle: the whole word
sequence is the only shingle. Repeated rows give equal rows. A NULL ``doc_id``
never becomes a component id unless all ids of the component are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name, shuffle_width
from strata.llm.components import connected_components
from strata.session import scratch_path


def fingerprint(text, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's word shingles."""
    words = text.encode("utf-8", "replace").lower().split() if isinstance(text, str) else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed)
                  for a, b in zip(starts[:len(words) - shingle + 1].tolist(),
                                  ends[shingle - 1:].tolist())]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at:at + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(shingle: int = 3, seed: int = 42):
    @F.pandas_udf(T.LongType())
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return simhash


def half_ball(max_bits: int) -> list[int]:
    """All 64-bit flip masks of at most ``max_bits / 2`` bits, as signed longs."""
    if max_bits < 0 or max_bits % 2:
        raise ValueError("max_bits must be even: both sides emit balls of half the radius")
    masks = [sum(1 << b for b in c) for k in range(max_bits // 2 + 1)
             for c in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(prints: DataFrame, max_bits: int = 2, width: int | None = None) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints (distinct, column ``fp``)
    within ``max_bits`` of each other; every link is verified."""
    masks = half_ball(max_bits)
    flips = F.array(*[F.lit(m) for m in masks])
    # By another expression than the one that made them distinct: that exchange
    # would be taken for this one and merged into a few partitions.
    spread = prints.repartition(width, F.xxhash64("fp")) if width else prints
    variants = spread.select("fp", F.posexplode(flips).alias("i", "flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"), "i")
    words = range(0, len(masks), 64)
    met = variants.groupBy("variant").agg(*[
        F.bit_or(F.when((F.col("i") >= w) & (F.col("i") < w + 64),
                        F.expr(f"shiftleft(1L, i - {w})")).otherwise(F.lit(0).cast("long"))).alias(f"m{w}")
        for w in words])
    several = met.where(sum((F.bit_count(f"m{w}") for w in words), F.lit(0)) > 1)
    found = F.concat(*[
        F.expr(f"transform(filter(sequence(0, {min(63, len(masks) - 1 - w)}), "
               f"i -> (shiftright(m{w}, i) & 1L) = 1L), i -> i + {w})") for w in words])
    members = several.select("variant", found.alias("found")).select(
        F.transform("found", lambda i: F.col("variant").bitwiseXOR(F.get(flips, i))).alias("fps"))
    pairs = members.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return pairs.where((F.col("a") != F.col("b")) & near).distinct()


def link_fingerprints(spark: SparkSession, rows: DataFrame, max_bits: int = 2) -> DataFrame:
    """``fp, root``: for every fingerprint of ``rows`` (a written table with
    column ``fp``) the smallest fingerprint it is connected with."""
    distinct = rows.select("fp").distinct()
    roots = connected_components(spark, near_links(distinct, max_bits, shuffle_width(spark)))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs`` (``doc_id, text``)."""
    path = scratch_path(spark, "simhash")
    docs.select("doc_id", fingerprint_column(shingle)(F.col("text")).alias("fp")).write.parquet(path)
    rows = spark.read.schema(T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])).parquet(path)
    roots = link_fingerprints(spark, rows, max_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    by_print = roots.join(least, "fp")
    by_root = by_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_print.join(by_root, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one of the
    smallest ``doc_id`` (NULLs last), then smallest text hash. Columns unchanged."""
    key, mark = free_name(docs, "_dedup_id"), free_name(docs, "_dedup_hash")
    none = free_name(docs, "_dedup_null")
    rowid = {key: F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
             none: F.col("doc_id").isNull(), mark: F.xxhash64("text")}
    path = scratch_path(spark, "simhash")
    docs.select(fingerprint_column(shingle)(F.col("text")).alias("fp"),
                *[c.alias(n) for n, c in rowid.items()]).write.parquet(path)
    rows = spark.read.schema(T.StructType([
        T.StructField("fp", T.LongType()), T.StructField(key, T.LongType()),
        T.StructField(none, T.BooleanType()), T.StructField(mark, T.LongType())])).parquet(path)
    roots = link_fingerprints(spark, rows, max_bits)
    # Equal rows share the three keys; how many they are rides along.
    keys, several = [none, key, mark], free_name(docs, "_dedup_rows")
    each = rows.groupBy("fp", *keys).agg(F.count(F.lit(1)).alias(several))
    first = F.min(F.struct(*keys, several)).alias("first")
    kept = (each.groupBy("fp").agg(first).join(roots, "fp").groupBy("root")
            .agg(F.min("first").alias("first")).select("first.*"))
    # One shuffle of the documents, joined without a sort; only rows that occur
    # more than once are sorted to drop their repeats.
    found = docs.withColumns(rowid).join(kept.hint("shuffle_hash"), keys)
    once = found.where(F.col(several) == 1).select(*docs.columns)
    repeated = found.where(F.col(several) > 1).dropDuplicates(keys).select(*docs.columns)
    return once.unionByName(repeated)
