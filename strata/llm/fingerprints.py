"""Document fingerprints by one-permutation MinHash (operator 5), in DataFrame functions.

A text's distinct five-word shingles are hashed once. The hash's high bits
name one of ``BINS`` bins, and the least hash of a bin is its value. An empty
bin takes the value of a filled one by optimal densification: it walks the
bins in a random order of its own (fixed by hashing bin pairs) to the first
filled one, which is the filled bin of least pair hash. ``BITS`` low bits of
each value are kept, two hex digits a bin. The likeness of two fingerprints is
the share of equal bins, corrected for equality by chance of so few bits.

Defined results: NULL text is empty. Fewer words than a shingle: the whole
sequence is the only shingle. No word: the fingerprint of zeros; two such are
alike (1), one such and another text are not (0). Equal texts have equal
fingerprints. The next document goes by ascending ``doc_id`` (NULLs first),
equal ids by text hash, then text; the last one's next is the first, and a
single document's next is itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import WHITE, let, shuffle_width
from strata.session import scratch_path

BINS, BITS = 128, 8
_HIGH = 64 - (BINS.bit_length() - 1)          # shift that leaves the bin number


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), f"[{WHITE}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, shingle: int = 5) -> Column:
    """Distinct hashes, ascending, of ``shingle`` neighbouring words of an array."""
    def of(w: Column) -> Column:
        n = F.size(w)
        several = F.transform(
            F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
        return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(
            F.sort_array(F.array_distinct(several)))
    return let(words, of)


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, _HIGH).cast("int")


def bin_values(sorted_hashes: Column) -> Column:
    """The least hash of every filled bin; equal high bits stand together."""
    return let(sorted_hashes, lambda s: F.filter(
        s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1)))))


def densified(filled: Column) -> Column:
    """A value per bin: its own, or that of the filled bin first in its order."""
    def of(v: Column) -> Column:
        return let(F.transform(v, bin_of), lambda bins: let(
            F.map_from_arrays(bins, v), lambda own: F.transform(
                F.sequence(F.lit(0), F.lit(BINS - 1)),
                lambda j: F.coalesce(F.element_at(own, j), F.get(v, F.array_position(bins, F.get(
                    bins, (F.array_position(
                        F.transform(bins, lambda b: F.xxhash64(j, b)),
                        F.array_min(F.transform(bins, lambda b: F.xxhash64(j, b)))) - 1).cast("int"))
                ).cast("int") - 1)))))
    return let(filled, lambda v: F.when(F.size(v) > 0, of(v)))


def packed(values: Column) -> Column:
    """Hex of the low ``BITS`` bits of every value; zeros for none."""
    digits = BITS // 4
    return F.coalesce(
        F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h.bitwiseAND((1 << BITS) - 1)), digits, "0")), ""),
        F.lit("0" * (BINS * digits)))


def fingerprint(text: Column, shingle: int = 5) -> Column:
    """The packed fingerprint of a text, as hex."""
    return packed(densified(bin_values(shingle_hashes(word_hashes(text), shingle))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated shingle similarity (0 to 1) of two fingerprints in hex."""
    def share(x: Column) -> Column:
        x, y = x["a"], x["b"]
        same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda j: F.substring(
            x, j, F.lit(1)) == F.substring(y, j, F.lit(1))))
        chance = 1.0 / (1 << BITS)
        return F.when((x == nothing) != (y == nothing), F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1.0 - chance)))
    if BITS != 8:
        raise ValueError("likeness() compares fingerprints of one byte a bin")
    nothing = F.lit(bytes(BINS))
    return let(F.struct(F.unhex(a).alias("a"), F.unhex(b).alias("b")), share)


_KEY = ["k_some", "k_id", "k_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNotNull().alias("k_some"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("k_id"),
                       F.xxhash64(text).alias("k_hash"), text.alias("text"))


def following(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """For every (id, text) of ``docs``: which document comes next in id order.

    Columns: the key, ``next_`` key, ``half`` (floor of half the text's code
    points) and ``times``: c equal rows follow each other c - 1 times and are
    followed by the next key once. Only keys and counts are shuffled. The order
    is global but never in one task: keys are range partitioned, numbered by
    their partition in a written table, and a partition's last key looks up the
    first key of the next one (one row per partition, broadcast).
    """
    width = shuffle_width(spark)
    keys = _keyed(docs).groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.first(F.floor(F.length("text") / 2).cast("int")).alias("half"))
    path = scratch_path(spark, "keys")
    keys.write.parquet(path)
    keys = spark.read.schema(keys.schema).parquet(path)
    placed = keys.repartitionByRange(width, *_KEY).withColumn("part", F.spark_partition_id())
    path = scratch_path(spark, "key-order")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)

    key = F.struct(*_KEY)
    # At most one row per range partition.
    firsts = placed.groupBy("part").agg(F.min(key).alias("first"))
    by_part = Window.orderBy("part")
    wrap = F.min("first").over(Window.partitionBy())
    after = firsts.select("part", F.coalesce(F.lead("first").over(by_part), wrap).alias("after"))
    within = Window.partitionBy("part").orderBy(*_KEY)
    chained = (placed.withColumn("next", F.lead(key).over(within)).join(F.broadcast(after), "part")
               .withColumn("next", F.coalesce("next", "after")))
    steps = F.array(F.struct(F.col("next").alias("to"), F.lit(1).cast("long").alias("times")),
                    F.struct(key.alias("to"), (F.col("n") - 1).alias("times")))
    return (chained.select(*_KEY, "half", F.explode(steps).alias("step")).where("step.times > 0")
            .select(*_KEY, *[F.col(f"step.to.{k}").alias(f"next_{k}") for k in _KEY], "half",
                    F.col("step.times").alias("times")))


def compare_with_next(spark: SparkSession, docs: DataFrame, shingle: int = 5) -> DataFrame:
    """Fingerprints of every text and of its edited text (its second half
    replaced by as much of the next document's beginning), and their likeness.

    Texts are shuffled once, by key; only the beginnings that a predecessor
    needs travel a second time.
    """
    width = shuffle_width(spark)
    texts = (_keyed(docs).withColumn("print", fingerprint(F.col("text"), shingle))
             .repartition(width, *_KEY).dropDuplicates(_KEY))
    steps = following(spark, docs)
    to = {f"next_{k}": k for k in _KEY}
    served = texts.select(*[F.col(k).alias(n) for n, k in to.items()], F.col("text").alias("next_text"),
                          F.col("print").alias("next_print"))
    starts = steps.join(served, list(to)).select(
        *_KEY, "times", "next_print", F.substring("next_text", F.lit(1), F.col("half")).alias("start"))
    n = F.length("text")
    edited = texts.join(starts, _KEY).select(
        F.when(F.col("k_some"), F.col("k_id")).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "times", n.cast("long").alias("n_chars"), F.col("print").alias("fingerprint"), "next_print",
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("start")).alias("edited"))
    scored = edited.select(
        "doc_id", "times", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        fingerprint(F.col("edited"), shingle).alias("edited_fingerprint"), "next_print")
    return scored.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")).drop("copy")
