import re
from collections import Counter

import duckdb
import pytest

from strata.llm import quality_rules as Q
from strata.llm import queries
from tests.llm.conftest import DOCS, rows


def brute(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


TEXTS = ["", None, " \n\t", "a b c a b c", "a a a a", "a b", "x y z\nx y z\n\nx y z ", "# | <b> & 100% $", "é è\né è\n漢",
         " ".join(["one two three"] * 4000 + [str(k) for k in range(9000)]), "w" * 200_000, "a b c d a b c\x0bq\x0ca b c"]


def test_counts_by_brute_force(spark):
    df = spark.createDataFrame(rows(TEXTS + TEXTS[3:5]), DOCS)
    for r in Q.judge(df).collect():
        text = (TEXTS + TEXTS[3:5])[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_quality_rules(spark, sf).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLE["op6_quality_rules"]).df().sort_values("doc_id").reset_index(drop=True)
    assert (got[sorted(got)] == want[sorted(want)]).all().all()


def test_clean_kept_and_junk_not(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op6_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    long = got[~got.base_failed]
    assert long[long.quality == 1].kept.mean() > 0.995 and long[long.quality == 0].kept.mean() < 0.02


def test_no_shuffle_and_no_python(spark):
    plan = queries.op6_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


def test_threshold_table_is_data(spark):
    df = spark.createDataFrame(rows([" ".join(f"word{k}" for k in range(80))]), DOCS)
    assert not Q.judge(df).first().kept                       # no stop words
    assert Q.judge(df, [("any", "n_symbols", "n_words", None, 10)]).first().kept
    assert not Q.judge(df, [("all", "n_words", "n_lines", None, 10)]).first().kept


def test_odd_rows(spark, odd_docs, no_docs):
    assert Q.judge(odd_docs).count() == 12 and Q.judge(no_docs).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 7, 8, 9])
def test_repeats_at_every_small_size(spark, n):
    text = " ".join("ab"[k % 2] for k in range(n))
    got = Q.judge(spark.createDataFrame(rows([text]), DOCS)).first()
    assert got.n_repeat_words == brute(text)[4]
