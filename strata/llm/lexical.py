"""Ranked lexical search, term-at-a-time and document-at-a-time (operator 11).

``build_index`` writes an inverted index of all documents: shards of
consecutive documents, a row for each term of a shard with its postings, and
one row with the shard's document lengths. ``search`` takes the queries in
blocks of a bounded size. For every shard and query:

- short lists are added up term at a time into accumulators, which then are one
  more iterator, bounded by the greatest accumulator of a stretch of documents;
- that iterator and the long lists are walked document at a time, in document
  order: a stretch whose bounds (greatest accumulator, greatest impact of each
  long list) cannot reach the query's current k-th score is skipped, and in the
  others only documents that can reach it are scored.

A shard returns its best k of each query, and Spark merges those. Weights and
scores are whole numbers (``weight``, ``impacts``); the bounds are exact, so
skipping loses nothing. A term in more than half of the documents weighs less
than 0: its bound is 0.

Defined results: NULL or empty texts have no term and are in no result; equal
scores rank by ``doc_id``, NULLs last; repeated rows are documents of their
own; every query row has its own ranks, equal ids too. No document or no term
in common gives no row. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

STRIDE = 256                     # documents of a stretch
HEADER = ""                      # the row of a shard's documents; never a term
NO_ID = 2 ** 63 - 1
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32
               for b in range(256))

INDEX = "shard long, term string, docs long, first binary, second binary"
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("docs", pa.int64()),
                    ("first", pa.binary()), ("second", pa.binary())])
HITS = "query int, doc_id long, score long"
_HITS = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


# --- the index --------------------------------------------------------------------

def indexer(shard_docs: int, shard_bytes: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def shard(ids, lengths, postings):
            names = list(postings)
            lists = [np.array(postings[t], "<u4").reshape(-1, 2) for t in names]
            n = np.array(lengths, np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([task << 32 | made] * (len(names) + 1), pa.int64()),
                pa.array([HEADER.encode(), *names], pa.binary()).cast(pa.string()),
                pa.array([len(ids), *map(len, lists)], pa.int64()),
                pa.array([np.array(ids, np.int64).tobytes(), *(x[:, 0].tobytes() for x in lists)], pa.binary()),
                pa.array([n.tobytes(), *(x[:, 1].tobytes() for x in lists)], pa.binary())], schema=_INDEX)

        ids, lengths, postings, held = [], [], {}, 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = terms(text) if text else []
                if not words:
                    continue
                at = len(ids)
                ids.append(NO_ID if i is None else i)
                lengths.append(len(words))
                held += len(text)
                for term, tf in Counter(words).items():
                    postings.setdefault(term, []).extend((at, tf))
                if len(ids) == shard_docs or held >= shard_bytes:
                    yield shard(ids, lengths, postings)
                    ids, lengths, postings, held, made = [], [], {}, 0, made + 1
        if ids:
            yield shard(ids, lengths, postings)
    return index


def build_index(spark: SparkSession, docs: DataFrame, shard_docs: int = 4096,
                shard_bytes: int = 8 << 20) -> DataFrame:
    """The index of ``docs`` (``doc_id, text``), written to the shared folder."""
    path = scratch_path(spark, "lexical-index")
    docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        indexer(shard_docs, shard_bytes), INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


# --- one shard --------------------------------------------------------------------

class _Best:
    """The k best documents of a query in a shard."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.least = k, np.zeros(0, np.int64), np.zeros(0, np.int64), 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate((self.score, score)), np.concatenate((self.doc, doc))
        best = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[best], doc[best]
        if len(best) == self.k:
            self.least = int(self.score[-1])      # an equal score may still have a smaller id


def shard_hits(ids: np.ndarray, lists: dict[str, tuple[np.ndarray, np.ndarray]], queries: list[dict[str, int]],
               weights: dict[str, int], k: int, short: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query, documents, scores)`` of a shard; ``lists``: documents and impacts of each term."""
    width = -(-len(ids) // STRIDE)
    dense, peaks = {}, {}
    for term, (at, impact) in lists.items():
        if len(at) > short:
            dense[term] = np.zeros(width * STRIDE, np.int64)
            dense[term][at] = impact
            peaks[term] = dense[term].reshape(width, STRIDE).max(1)
    for number, query in enumerate(queries):
        own = [t for t in query if t in lists]
        if not own:
            continue
        best, summed = _Best(k), np.zeros(width * STRIDE, np.int64)
        for term in own:                               # term at a time
            if term not in dense:
                at, impact = lists[term]
                summed[at] += query[term] * weights[term] * impact
        long_lists = [(query[t] * weights[t], t) for t in own if t in dense]
        bound = summed.reshape(width, STRIDE).max(1)
        ahead = sum((w * peaks[t] for w, t in long_lists if w > 0), np.zeros(width, np.int64))
        for stretch in np.flatnonzero(bound + ahead > 0).tolist():       # documents at a time
            if bound[stretch] + ahead[stretch] < best.least:
                continue
            a, b = stretch * STRIDE, (stretch + 1) * STRIDE
            score = summed[a:b]
            may = np.flatnonzero(score + ahead[stretch] >= best.least)
            score = score[may]
            for w, term in long_lists:
                score = score + w * dense[term][a:b][may]
            good = score >= best.least
            if good.any():
                best.add(score[good], ids[a + may[good]])
        if len(best.score):
            yield number, best.doc, best.score


def searcher(queries: list[dict[str, int]], weights: dict[str, int], n_docs: int, n_terms: int, k: int,
             short_share: float):
    def search_shard(rows: pa.Table) -> pa.Table:
        ids = lengths = None
        found = {}
        for term, first, second in zip(*(rows[c].to_pylist() for c in ("term", "first", "second"))):
            if term == HEADER:
                ids, lengths = np.frombuffer(first, np.int64), np.frombuffer(second, np.int64)
            else:
                found[term] = (np.frombuffer(first, "<u4").astype(np.int64), np.frombuffer(second, "<u4").astype(np.int64))
        m = 75 + 25 * lengths * n_docs // n_terms
        order = np.argsort(ids, kind="stable")         # documents by id
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lists = {t: (place[at], impacts(tf, m[at])) for t, (at, tf) in found.items()}
        out = [(np.full(len(doc), q, np.int32), doc, score) for q, doc, score in shard_hits(
            ids[order], lists, queries, weights, k, int(short_share * len(ids)))]
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _HITS)], schema=_HITS)
    return search_shard


# --- the search -------------------------------------------------------------------

def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[dict[str, int]]]]:
    """Ids and terms of the queries, at most about ``block_bytes`` of text at a time."""
    ids, queries, held = [], [], 0
    for row in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        query = Counter(t.decode() for t in terms((row.text or "").encode("utf-8", "replace")))
        if not query:
            continue
        ids.append(row.item_id)
        queries.append(dict(query))
        held += len(row.text)
        if held >= block_bytes:
            yield ids, queries
            ids, queries, held = [], [], 0
    if ids:
        yield ids, queries


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = 1 << 20,
           short_share: float = 1 / 16, index: DataFrame | None = None) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every row of
    ``items`` (``item_id, text``). Lists of at most ``short_share`` of a shard's
    documents are short. Each block of queries reads the written index once for
    its document frequencies and once for its postings."""
    index = build_index(spark, docs) if index is None else index
    head = index.where(F.col("term") == HEADER)
    total = head.agg(F.sum("docs"), F.sum(F.octet_length("first"))).first()
    n_docs, out = int(total[0] or 0), scratch_path(spark, "lexical-hits")
    id_type = items.schema["item_id"].dataType.simpleString()
    n_terms = _term_total(head) if n_docs else 0
    schema = f"item_id {id_type}, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for ids, queries in _blocks(items, block_bytes) if n_docs else ():
        # A block is bounded, and so are its distinct terms.
        asked = sorted({t for q in queries for t in q})
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in [HEADER, *asked]], "term string"))
        frequency = index.join(wanted, "term").groupBy("term").agg(F.sum("docs").alias("df")).collect()
        weights = {r.term: weight(n_docs, r.df) for r in frequency if r.term != HEADER}
        hits = index.join(wanted, "term").groupBy("shard").applyInArrow(
            searcher(queries, weights, n_docs, n_terms, k, short_share), HITS)
        ranked = hits.withColumn("rank", F.expr("row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id)")
                                 ).where(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(ids)), f"query int, item_id {id_type}"))
        ranked.join(names, "query").select(
            "item_id", F.col("rank").cast("int").alias("rank"),
            F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _term_total(head: DataFrame) -> int:
    """Terms of all documents, from the lengths in the shards' rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(np.frombuffer(b, np.int64).sum()) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64())], names=["n"])

    return int(head.select("second").mapInArrow(add, "n long").agg(F.sum("n")).first()[0] or 0)


def oracle(k: int = 20) -> str:
    """DuckDB: the scores of all documents with a term of the item."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = lambda c: (f"regexp_extract_all(translate({c}, '{upper}', '{lower}'), "  # noqa: E731
                       r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS ws FROM documents WHERE text IS NOT NULL),
t AS (SELECT sum(len(ws)) AS l, count(*) FILTER (len(ws) > 0) AS nd FROM d),
m AS (SELECT r, doc_id, 75 + CAST((25 * len(ws) * nd) // l AS BIGINT) AS m FROM d, t WHERE len(ws) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), t),
b AS (SELECT row_number() OVER () AS q, item_id, {words("text")} AS ws FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(ws) AS term FROM b) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id,
             CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
z AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM z WHERE rank <= {k}"""
