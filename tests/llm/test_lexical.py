import math
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from strata.llm import lexical, queries
from tests.llm.conftest import DOCS, SF, rows

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """(query number, rank, doc_id, score), every document scored for every query."""
    docs = [(i, Counter(words(t))) for i, t in docs]
    docs = [d for d in docs if d[1]]
    n_docs, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for q, text in enumerate(items):
        asked, scored = Counter(words(text)), []
        for i, tf in docs:
            m = 75 + 25 * sum(tf.values()) * n_docs // total
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m)) for t, times in asked.items() if tf[t])
            if score > 0:
                scored.append((-score, 2 ** 63 - 1 if i is None else i, i))
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return sorted(out, key=str)


def test_query_against_sql_and_brute_force(spark, small):
    found = sorted(map(tuple, queries.op11_lexical_search(spark, SF).collect()))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert found == sorted(con.sql(queries.ORACLE["op11_lexical_search"]).fetchall())
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    want = brute(list(zip(small["documents"].doc_id.tolist(), small["documents"].text)), items.text, 20)
    assert found == sorted((items.item_id[q], r, i, s) for q, r, i, s in want)


@pytest.mark.parametrize("sizes", [{"shard_docs": 7}, {"shard_docs": 300}, {"shard_bytes": 400}])
@pytest.mark.parametrize("short_share,block_bytes", [(0.0, 1), (1 / 16, 30), (1.0, 1 << 20)])
def test_lists_shards_and_blocks(spark, sizes, short_share, block_bytes):
    rng = np.random.default_rng(11)
    vocabulary = ["the", "a", "of", *(f"w{k}" for k in range(30))]
    chance = 1 / np.arange(1, 34) ** 1.2
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 25)), p=chance / chance.sum())) for _ in range(280)]
    docs = [(int(rng.integers(0, 200)), t, "en", "s", None) for t in texts] + [(None, "the w7 w9", None, None, None)]
    items = ["the of w3 w3", "w7 w29 W12", "the", "none such", "", None, "a w1 w2 w4 w5 w6 w8 the the"]
    asked = spark.createDataFrame([(q, t) for q, t in enumerate(items)], "item_id int, text string")
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    index = lexical.build_index(spark, df, **sizes)
    got = lexical.search(spark, df, asked, 5, block_bytes, short_share, index)
    assert sorted(map(tuple, got.collect()), key=str) == brute([d[:2] for d in docs], items, 5)


def test_skipping_skips(monkeypatch):
    """Stretches that cannot reach the k-th score are not scored."""
    added, add = [], lexical._Best.add
    monkeypatch.setattr(lexical._Best, "add", lambda self, s, d: (added.append(len(s)), add(self, s, d))[1])
    ids, n = np.arange(100 * lexical.STRIDE), 100 * lexical.STRIDE
    impact = np.full(n, 5)
    impact[:50] = 1000
    lists = {"long": (ids, impact), "rare": (np.array([n - 1]), np.array([2000]))}
    hits = list(lexical.shard_hits(ids, lists, [{"long": 1, "rare": 1}], {"long": 3, "rare": 9}, 3, 10))
    assert [(q, d.tolist(), s.tolist()) for q, d, s in hits] == [(0, [n - 1, 0, 1], [18015, 3000, 3000])]
    assert len(added) == 2


def test_odd_rows(spark, odd_docs, no_docs):
    items = ["river mill", None, "", "WORD x straße 漢字", "nothing"]
    asked = spark.createDataFrame([(9, t, 1) for t in items], "item_id long, text string, rank int")
    got = lexical.search(spark, odd_docs, asked)
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], items, 20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((9, *w[1:]) for w in want), key=str)
    assert lexical.search(spark, no_docs, asked).count() == 0
    assert lexical.search(spark, odd_docs, asked.where(F.lit(False))).count() == 0
    assert lexical.search(spark, spark.createDataFrame(rows([None, "..."]), DOCS), asked).count() == 0
