from collections import Counter, defaultdict

import duckdb
import regex

from strata.llm import divergence, queries
from tests.llm.conftest import DOCS, SF, rows

TERM = regex.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, min_docs, top):
    """Rows of the audit from (text, lang, source), term by term."""
    counts, docs_of, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        words = TERM.findall(lower(text or ""))
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs_of[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs_of[lang].items() if n >= min_docs]
        p = {}
        for g in [s for x, s in groups if x == lang] + [None]:
            own = counts[lang, g] if g is not None else sum((counts[k] for k in groups if k[0] == lang), Counter())
            total = sum(own[t] for t in kept)
            p[g] = {t: 1 + 10 ** 9 * (own[t] + 5) // (total + 5 * len(kept)) for t in kept}
        pairs = [(o, sum(abs(p[source][t] - p[o][t]) for t in kept)) for o in p if o not in (source, None)]
        more = [(t, p[source][t] - p[None][t]) for t in kept if counts[lang, source][t] and p[source][t] > p[None][t]]
        for part, items, most in (("pair", pairs, None), ("term", more, top)):
            items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items)]
    return sorted(out)


def test_query_against_sql_and_brute_force(spark, small):
    found = sorted(map(tuple, queries.op13_source_divergence(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert found == sorted(con.sql(queries.ORACLE["op13_source_divergence"]).fetchall())
    docs = small["documents"]
    assert found == brute(zip(docs.text, docs.lang, docs.source), 30, 50)


def test_small_blocks_and_nulls(spark, monkeypatch):
    texts = ["Élan river RIVER mill", "mill mill a1b2_c", "", None, "river 漢字 漢字", "zz yy xx mill", "mill"] * 3
    data = [(k, t, ["en", None, "de"][k % 3], ["a", "b", None, "d"][k % 4], None) for k, t in enumerate(texts)]
    data += [(90, None, "xx", "only", 0), (91, "solo", "yy", "p", 0), (92, "solo", "yy", "q", 0), (92, "solo", "yy", "q", 0)]
    df = spark.createDataFrame(data, DOCS).repartition(4)
    for least in (1, 2, 3, 9):
        got = divergence.audit(spark, df, min_docs=least, top=2, block_terms=2)
        assert sorted(map(tuple, got.collect())) == brute([r[1:4] for r in data], least, 2)


def test_shares_are_exact_beyond_64_bits(spark):
    n, total = 9 * 10 ** 15, 10 ** 17 + 3
    got = spark.createDataFrame([(n, total, 7)], "n long, t long, k long").select(
        divergence.share(*(map(__import__("pyspark").sql.functions.col, "ntk")))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 5) // (total + 35)


def test_odd_rows(spark, odd_docs, no_docs):
    data = [(r.text, r.lang, r.source) for r in odd_docs.collect()]
    got = divergence.audit(spark, odd_docs, min_docs=1)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(data, 1, 50)
    assert divergence.audit(spark, no_docs).count() == 0
    silent = spark.createDataFrame(rows([None, "1 2 3"]), DOCS)
    assert divergence.audit(spark, silent).count() == 0
