"""Quality rules compiled into one projection (operator 6), DataFrame functions only.

``RULES`` is a threshold table: a ratio of two counts and the range, in
percent, in which a text passes. ``verdict`` turns it into one boolean
expression over the counts that ``counted`` computes in the same row; nothing
is shuffled.

Defined results: NULL or empty text has no words and all counts zero; it fails
the base rule. Equal texts give equal rows, each row by itself. A ratio whose
denominator is zero passes (its text has no words and fails the base rule).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WHITE, let

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that was for on be with as by at it "
    "de la le les des et en un une du que qui est pour dans sur "
    "der die das und den von mit ist ein eine nicht sich auf im "
    "el los las y del por con se no una su para es").split()

#: name, numerator, denominator, least percent, most percent (None: open).
RULES = [
    ("word length", "word_chars", "n_words", 200, 1500),
    ("symbols to words", "n_symbols", "n_words", None, 20),
    ("stop words", "n_stop_words", "n_words", 1, None),
    ("repeated lines", "n_dup_lines", "n_lines", None, 50),
    ("capital words", "n_capital_words", "n_words", None, 40),
    ("short lines", "n_short_lines", "n_lines", None, 80),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words stand in a ``window``-word window that the text holds twice or more.

    Window hashes get their position in the low bits and are sorted, so equal
    windows become neighbours; the full hashes of neighbours are then compared.
    Linear but for the sort, however often a window occurs.
    """
    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(0), n - window),
                             lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        # Bits that hold every position.
        bits = F.ceil(F.log2(n.cast("double"))).cast("int")
        return let(hashes, lambda h: let(bits, lambda s: let(
            F.sort_array(F.transform(h, lambda x, i: F.call_function(
                "shiftleft", F.call_function("shiftright", x, s), s).bitwiseOR(i.cast("long")))),
            lambda p: covered(h, s, p))))

    def covered(h: Column, s: Column, p: Column) -> Column:
        def prefix(x):
            return F.call_function("shiftright", x, s)

        def at(x):
            return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s) - 1).cast("int")

        def same(x, y):
            return F.coalesce((prefix(x) == prefix(y)) & (F.get(h, at(x)) == F.get(h, at(y))), F.lit(False))
        twice = F.filter(p, lambda x, j: same(x, F.get(p, j - 1)) | same(x, F.get(p, j + 1)))
        return let(F.sort_array(F.transform(twice, at)), lambda d: F.aggregate(
            F.transform(d, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(d, j + 1) - x, F.lit(window)))),
            F.lit(0), lambda a, x: a + x))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda w: F.when(
        F.size(w) >= window, of(w)).otherwise(F.lit(0))).cast("long")


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every text."""
    def removed(what: str) -> Column:
        return (F.length("text") - F.length(F.regexp_replace("text", what, ""))).cast("long")

    def number(a: Column) -> Column:
        return F.size(a).cast("long")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "text", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{WHITE}]")).alias("lines"))
    return rows.select(
        "doc_id", number(F.col("words")).alias("n_words"),
        (F.length("text").cast("long") - removed(f"[{WHITE}]+")).alias("word_chars"),
        removed("[#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        number(F.col("lines")).alias("n_lines"),
        number(F.filter("words", lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
        number(F.filter("words", lambda w: w.rlike(r"^[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*$"))).alias("n_capital_words"),
        number(F.filter("lines", lambda x: F.length(x) < 20)).alias("n_short_lines"))


def verdict(rules=RULES) -> Column:
    """One expression of the whole table, in whole numbers."""
    tests = []
    for _, a, b, low, high in rules:
        if low is not None:
            tests.append(100 * F.col(a) >= low * F.col(b))
        if high is not None:
            tests.append(100 * F.col(a) <= high * F.col(b))
    return reduce(lambda x, y: x & y, tests, F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    return counted(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def oracle(rules=RULES) -> str:
    """The same in DuckDB SQL over the table ``documents``, from the definitions."""
    white = r"[\x20\x09-\x0D]+"
    tests = " AND ".join([f"100 * {a} >= {low} * {b}" for _, a, b, low, _ in rules if low is not None]
                         + [f"100 * {a} <= {high} * {b}" for _, a, b, _, high in rules if high is not None])
    stop = ", ".join(f"'{w}'" for w in sorted(STOP_WORDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, list_filter(string_split_regex(text, '{white}'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS o(k) GROUP BY r),
c AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(hit.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        len(list_filter(ws, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
        len(list_filter(ws, lambda x: regexp_full_match(x, '[^a-z]*[A-Z][^a-z]*[A-Z][^a-z]*')))::BIGINT AS n_capital_words,
        len(list_filter(ls, lambda x: length(x) < 20))::BIGINT AS n_short_lines
      FROM d JOIN w USING (r) LEFT JOIN hit USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT *, (NOT base_failed) AND {tests} AS kept FROM f"""
