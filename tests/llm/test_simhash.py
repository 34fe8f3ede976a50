import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import queries, simhash
from strata.llm.components import connected_components
from tests.llm.conftest import DOCS, SF, rows


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(links):
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def brute_components(ids, prints, max_bits=2):
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1)
             if bin(prints[i] ^ prints[j]).count("1") <= max_bits]
    return brute_roots(links)


def test_query_against_brute_force(spark, small):
    got = queries.op9_simhash(spark, SF).toPandas().set_index("doc_id")
    docs = small["documents"]
    prints = [brute_print(t) for t in docs.text]
    assert [got.fingerprint[k] for k in docs.doc_id] == [f"{p:016x}" for p in prints]
    want = brute_components(docs.doc_id.tolist(), prints)
    assert got.component_id.to_dict() == want


@pytest.mark.parametrize("max_bits", [0, 2, 4])
def test_every_near_pair_is_connected(spark, max_bits):
    rng = np.random.default_rng(max_bits)
    prints = set()
    for _ in range(6):
        p = int(rng.integers(0, 2 ** 63))
        for _ in range(8):
            prints.add(p)
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                p ^= 1 << int(b)
    prints |= {0, 2 ** 64 - 1, 1, 3, 7, 1 << 63}
    prints = sorted(prints)
    signed = [p - 2 ** 64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    got = {r.fp: r.root for r in simhash.link_fingerprints(spark, df, max_bits).collect()}
    groups = pd.Series(brute_components(prints, prints, max_bits))
    mine = pd.Series({p: got[s] for p, s in zip(prints, signed)})
    assert mine.nunique() == groups.nunique()
    assert (pd.DataFrame({"a": groups, "b": mine}).groupby("a").b.nunique() == 1).all()
    with pytest.raises(ValueError):
        simhash.half_ball(3)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(5)
    links = {"path": [(k, k + 1) for k in range(60)], "star": [(99, k) for k in range(50)] + [(200, 201), (7, 7)],
             "random": [tuple(map(int, p)) for p in rng.integers(0, 80, (60, 2))], "none": []}[shape]
    got = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = brute_roots([p for p in links if p[0] != p[1]])
    assert got == want


def test_one_of_each_group_stays(spark):
    base = " ".join(f"w{k % 37} x{k % 11}" for k in range(400))
    texts = [base, base, base.upper(), "quite another text of its own kind here", "", None, " "]
    docs = spark.createDataFrame(rows(texts, first=10) + rows(texts[:1], first=10), DOCS)
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [10, 13, 14]


def test_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(spark, odd_docs).toPandas()
    assert len(got) == 12 and got.doc_id.isna().sum() == 3 and (got.fp == 0).sum() == 4
    docs = odd_docs.toPandas()
    kept = simhash.keep_one(spark, odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(map(simhash.fingerprint, docs.text)))
    assert simhash.near_duplicates(spark, no_docs).count() == 0 and simhash.keep_one(spark, no_docs).count() == 0
    nameless = odd_docs.where("doc_id is null")
    assert simhash.near_duplicates(spark, nameless).where("component_id is null").count() == 3
    assert simhash.keep_one(spark, nameless).count() == 2
    assert odd_docs.select(F.count_distinct("doc_id")).first()[0] == 8
