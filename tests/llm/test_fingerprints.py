import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import fingerprints as P
from strata.llm import queries
from tests.llm.conftest import DOCS, SF, rows


def shingles(text, n=5):
    words = [w.lower() for w in re.split(r"[ \t-\r]+", text or "") if w]
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def likeness(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def test_query_against_brute_force(spark, small):
    docs = small["documents"].sort_values("doc_id").reset_index(drop=True)
    got = queries.op5_fingerprints(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (got.doc_id == docs.doc_id).all()
    errors, following = [], []
    for k, text in enumerate(docs.text):
        after = docs.text[(k + 1) % len(docs)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got.n_chars[k] == len(text) and got.edited_sha256[k] == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(got.near_edited[k] - likeness(shingles(text), shingles(edited)))
        following.append(got.near_next[k] - likeness(shingles(text), shingles(after)))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06 and np.abs(following).max() < 0.12
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()


def brute_print(hashes):
    """One-permutation MinHash with densification, from the definition, over given shingle hashes."""
    import xxhash
    bins = {}
    for h in hashes:
        u = h & (2 ** 64 - 1)
        b = u >> P._HIGH
        bins[b] = min(bins.get(b, 2 ** 64), u)

    def signed(x):
        return x - 2 ** 64 if x >> 63 else x

    def pair(j, b):
        # Spark hashes ints as 4 bytes each, the second seeded with the first's hash.
        return signed(xxh_int(b, xxh_int(j, 42)))

    def xxh_int(value, seed):
        return xxhash.xxh64_intdigest(int(value).to_bytes(4, "little"), seed)
    if not bins:
        return "0" * (2 * P.BINS)
    return "".join(f"{bins[j if j in bins else min(bins, key=lambda b: pair(j, b))] & 255:02X}" for j in range(P.BINS))


def test_densified_bins_by_definition(spark):
    texts = ["one two three four five six", " ".join(f"w{k}" for k in range(60)), "", "a b", " ".join("xyz" * 40)]
    df = spark.createDataFrame(rows(texts), DOCS)
    h = P.shingle_hashes(P.word_hashes(F.col("text")))
    for r in df.select(h.alias("h"), P.fingerprint(F.col("text")).alias("p")).collect():
        assert r.p == brute_print(r.h)


def test_no_python_in_the_plan(spark, small):
    df = queries.op5_fingerprints(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_odd_rows(spark, odd_docs, no_docs):
    got = P.compare_with_next(spark, odd_docs).toPandas()
    docs = odd_docs.toPandas()
    docs["text"] = docs.text.fillna("")
    assert len(got) == 12 and got.doc_id.isna().sum() == 3
    assert sorted(got.n_chars) == sorted(docs.text.map(len))
    zero = "0" * (2 * P.BINS)
    assert (got.fingerprint == zero).sum() == 4
    # Equal rows follow each other: the first of the two is alike to its next, edited by itself.
    twins = got[(got.doc_id == 0)]
    assert len(twins) == 2 and twins.fingerprint.nunique() == 1 and (twins.near_next == 1).all()
    assert P.compare_with_next(spark, no_docs).count() == 0


def test_ends_wrap_and_ties(spark):
    one = P.compare_with_next(spark, spark.createDataFrame(rows(["abcdef gh"]), DOCS)).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [
        (1.0, hashlib.sha256(("abcdef gh"[:5] + "abcd").encode()).hexdigest())]
    tied = [(1, "aa bb", None, None, None), (1, "cc dd ee", None, None, None), (2, "x", None, None, None)]
    got = P.compare_with_next(spark, spark.createDataFrame(tied, DOCS))
    again = P.compare_with_next(spark, spark.createDataFrame(tied[::-1], DOCS).repartition(3))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect())) and got.count() == 3
