import hashlib

import duckdb
import numpy as np
import pytest

from strata.llm import queries, suffix_dedup
from tests.llm.conftest import DOCS, SF, rows


def brute(docs, n=suffix_dedup.LENGTH):
    """(doc_id, bytes, removed, spans, hash) of every (doc_id, text)."""
    key = lambda i: suffix_dedup.NO_ID if i is None else i
    least, out = {}, []
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            least[b[k:k + n]] = min(least.get(b[k:k + n], key(i)), key(i))
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - n + 1):
            if least[b[k:k + n]] < key(i):
                gone[k:k + n] = True
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, df, **sizes):
    found = suffix_dedup.digest(suffix_dedup.remove_repeats(spark, df, **sizes))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def test_query_against_sql_and_brute_force(spark, small):
    found = sorted(map(tuple, queries.op12_suffix_dedup(spark, SF).collect()), key=str)
    docs = small["documents"]
    assert found == brute(list(zip(docs.doc_id.tolist(), docs.text)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert found == sorted(con.sql(queries.ORACLE["op12_suffix_dedup"]).fetchall(), key=str)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 500, "bucket_bytes": 700, "order_bytes": 600}])
def test_shared_and_periodic_passages(spark, sizes):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(words[k] for k in rng.integers(0, 300, n))
    shared, line = prose(40), "All rights reserved by the society of the river mill."
    texts = [prose(30) + shared + prose(20), shared, prose(10) + shared[7:120] + prose(5), shared[-49:], shared[-50:],
             "a" * 400, "a" * 51 + "b" + "a" * 49, "ab" * 60, "ba" * 60, "é" * 80, "xé" + "é" * 30]
    texts += [prose(12) + line + prose(12) for _ in range(40)]          # one line in many surroundings
    texts += [texts[0], texts[0][:-3] + "zzz"]
    docs = rows(texts)
    docs += [(3, shared, "en", "s", 1), (0, texts[2], "en", "s", 1)]       # repeated ids, other texts
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    assert got(spark, df, **sizes) == brute([r[:2] for r in docs])


def test_long_text_is_cut_anywhere(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_ROUND", 300)
    rng = np.random.default_rng(4)
    long = bytes(rng.integers(97, 101, 4000, dtype=np.uint8)).decode()
    a = suffix_dedup.stretches(np.frombuffer(long.encode(), np.uint8), np.array([4000]), None)
    assert np.array_equal(np.sort(np.concatenate([np.arange(f, f + n) for f, n in zip(a[2], a[3])])),
                          np.arange(4000 - 49))


def test_common_grams_change_no_window():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 3000, dtype=np.uint8)
    marks = rng.random(1 << 20) < 0.5
    ends = np.array([100, 130, 131, 1500, 3000])
    want = [k for k in range(3000 - 49) if np.searchsorted(ends, k, side="right") == np.searchsorted(ends, k + 49, side="right")]
    for common in (None, marks):
        anchor, body, first, n = suffix_dedup.stretches(text, ends, common)
        assert np.concatenate([np.arange(f, f + c) for f, c in zip(first, n)]).tolist() == want
        seen = {}                                # equal windows: equal anchors at the same place
        for a, f, c in zip(anchor.tolist(), first.tolist(), n.tolist()):
            for k in range(f, f + c):
                assert seen.setdefault(text[k:k + 50].tobytes(), a) == a


@pytest.mark.parametrize("n,letters", [(0, 2), (1, 2), (2, 2), (61, 1), (400, 1), (2000, 2), (2001, 26), (2002, 3)])
def test_difference_cover_order(n, letters):
    text = np.random.default_rng(n).integers(97, 97 + letters, n, dtype=np.uint8)
    if n == 2002:
        text = np.tile(text[:91], 22)            # many suffixes agree in 50 bytes and more
    order = suffix_dedup.difference_cover_order(text)
    raw = text.tobytes()
    assert sorted(order.tolist()) == list(range(n))
    prefixes = [raw[k:k + 50] for k in order]
    assert prefixes == sorted(prefixes)
    if n >= 50:
        starts, new = suffix_dedup.window_classes(text, np.arange(n) <= n - 50)
        classes = np.cumsum(new)
        assert len({(c, raw[k:k + 50]) for c, k in zip(classes.tolist(), starts.tolist())}) == len(
            {raw[k:k + 50] for k in range(n - 49)}) == classes[-1]


def test_odd_rows(spark, odd_docs, no_docs):
    found = got(spark, odd_docs)
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect() if len(r.text or "") < 10_000])
    assert len(found) == 12 and [f for f in found if f[1] < 10_000] == want
    long = [f for f in found if f[1] > 10_000]
    assert len(long) == 2 and all(f[2] == f[3] == 0 for f in long)
    assert got(spark, no_docs) == []
    assert got(spark, spark.createDataFrame(rows([None, "", "short"]), DOCS)) == brute([(0, None), (1, ""), (2, "short")])
