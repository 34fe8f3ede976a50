"""Divergence of the sources of a language, over run-length columns (operator 13).

Terms are counted per (lang, source) in the scan; each language keeps those in
at least ``MIN_DOCS`` of its documents. A group's smoothed share of a term is
``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``, exact.

- Pairs of sources: the kept terms are put in an order in which terms with
  equal counts in all sources are neighbours (by their vectors of counts), and
  cut into blocks. In a block every group is a column of counts, run-length
  encoded, absent terms as runs of 0. For each pair the run boundaries of both
  columns are intersected and ``|p - p'|`` is multiplied by the run length;
  sums over the blocks are the values.
- Terms: the terms a source uses most beyond its language, by ``p - q``.

Defined results: NULL text, lang and source are ''. A group without terms has
counts of 0; a language without kept terms has pairs of value 0 and no term
rows; a source alone in its language has no pair. Repeated rows count as often
as they occur. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

MIN_DOCS, TOP_TERMS = 30, 50
SCALE, PRIOR = 10 ** 9, 5
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
_RUNS = pa.schema([("lang", pa.string()), ("block", pa.int64()), ("source", pa.string()),
                   ("n_terms", pa.int64()), ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_BYTES).split()


def counter(held_terms: int = 200_000):
    """Counts of a task's documents; given out whenever so many are held."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}

        def out():
            for (lang, source), own in n.items():
                seen, words = docs[lang, source], list(own)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()), pa.array(list(own.values()), pa.int64()),
                    pa.array([seen[w] for w in words], pa.int64())], schema=_COUNTS)

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2).cast(pa.binary()).to_pylist()):
                words = terms(text)
                if words:
                    n.setdefault((lang, source), Counter()).update(words)
                    docs.setdefault((lang, source), Counter()).update(set(words))
            if sum(map(len, n.values())) > held_terms:
                yield from out()
                n, docs = {}, {}
        yield from out()
    return count


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE (count + PRIOR) / (total + PRIOR kept))`` in whole numbers of any size."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = wide(count + F.lit(PRIOR)) * F.lit(SCALE).cast("decimal(10,0)")
    below = wide(total + F.lit(PRIOR) * kept)
    return F.call_function("div", top, below) + F.lit(1).cast("long")


def encode_runs(block_terms: int):
    """Blocks of the ordered terms of a task -> one run-length column a source."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def block(lang, vectors):
            places: dict[str, tuple[list, list]] = {}
            for at, vector in enumerate(vectors):
                for cell in vector:
                    own = places.setdefault(cell["source"], ([], []))
                    own[0].append(at)
                    own[1].append(cell["n"])
            out = {f.name: [] for f in _RUNS}
            for source, (at, counts) in [(None, ([], [])), *places.items()]:
                column = np.zeros(len(vectors), np.int64)
                column[at] = counts
                starts = np.flatnonzero(np.diff(column, prepend=-1))
                for name, value in zip(out, (lang, task << 32 | made, source, len(vectors),
                                             starts.tolist(), column[starts].tolist())):
                    out[name].append(value)
            return pa.RecordBatch.from_pydict(out, schema=_RUNS)

        at_lang, held = None, []
        for batch in batches:
            for lang, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (lang != at_lang or len(held) == block_terms):
                    yield block(at_lang, held)
                    held, made = [], made + 1
                at_lang = lang
                held.append(vector)
        if held:
            yield block(at_lang, held)
    return encode


def pair_sums(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One block: the sum of ``|p - p'|`` over its terms for every pair of groups."""
    columns = []
    for row in rows.sort_by("source").to_pylist():
        starts, counts = row["starts"] or [0], row["counts"] or [0]
        below = row["total"] + PRIOR * row["kept"]
        p = [1 + SCALE * (c + PRIOR) // below for c in counts] if row["n_terms"] else [0]
        columns.append((row["source"], np.array(starts), np.array(p, np.int64)))
    n = rows["n_terms"][0].as_py()
    out = {f.name: [] for f in _PAIRS}
    for i, (one, starts, p) in enumerate(columns):
        for other, starts2, p2 in columns[:i]:
            cuts = np.union1d(starts, starts2)
            length = np.diff(np.append(cuts, n))
            f = np.abs(p[np.searchsorted(starts, cuts, side="right") - 1]
                       - p2[np.searchsorted(starts2, cuts, side="right") - 1])
            value = int((f * length).sum())
            for a, b in ((one, other), (other, one)):
                for name, v in zip(out, (key[0].as_py(), a, b, value)):
                    out[name].append(v)
    return pa.table(out, schema=_PAIRS)


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
          block_terms: int = 8192) -> DataFrame:
    """``lang, source, part, item, value, rank`` as the docstring of the module says."""
    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"divergence-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    # Counts of one term meet in one task: every later grouping by it needs no shuffle.
    counts = docs.mapInArrow(counter(), "lang string, source string, term string, n long, docs long")
    cells = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    vectors = written(cells.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"),
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells"))
        .where(F.col("docs") >= min_docs), "terms")

    flat = vectors.select("lang", "term", "in_lang", F.inline("cells"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = vectors.groupBy("lang").agg(F.sum("in_lang").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    zero = F.lit(0).cast("long")
    groups = written(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
                     .join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "kept")]), "groups")

    p = share(F.col("n"), F.col("total"), F.col("kept"))
    q = share(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    excess = flat.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")

    # Ranges by a short key (the driver samples it), the full order inside them.
    first = F.get("cells", F.lit(0))
    ordered = vectors.select("lang", "cells").repartitionByRange(
        "lang", F.size("cells"), first["source"], first["n"], F.xxhash64("cells")
    ).sortWithinPartitions("lang", F.size("cells"), "cells")
    runs = written(ordered.mapInArrow(encode_runs(block_terms), "lang string, block long, source string, "
                                      "n_terms long, starts array<long>, counts array<long>"), "runs")
    blocks = runs.where("source IS NULL").select("lang", "block", "n_terms").unionByName(
        groups.where("kept = 0").select("lang", F.lit(-1).cast("long").alias("block"), zero.alias("n_terms")).distinct())
    columns = blocks.join(groups, "lang").join(
        runs.select("lang", "block", "source", "starts", "counts"), ["lang", "block", "source"], "left")
    pairs = columns.groupBy("lang", "block").applyInArrow(
        pair_sums, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    rank = F.expr("row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)")
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                                       rank.alias("rank"))
    return named(pairs, "pair").unionByName(named(excess, "term").where(F.col("rank") <= top))


def oracle() -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    p = lambda n, total: f"1 + ({SCALE} * (CAST({n} AS HUGEINT) + {PRIOR})) // ({total} + {PRIOR} * kept)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS in_lang FROM c GROUP BY ALL HAVING sum(docs) >= {MIN_DOCS}),
l AS (SELECT lang, sum(in_lang) AS lang_total, count(*) AS kept FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(any_value(lang_total), 0) AS lang_total, coalesce(any_value(kept), 0) AS kept
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang) GROUP BY lang, source),
s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, in_lang, lang_total, kept,
             sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT lang, source, term, n, {p("n", "total")} AS p, {p("in_lang", "lang_total")} AS q FROM s),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
allpair AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM allpair
      UNION ALL SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM z WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
