"""Every registered query with an oracle matches DuckDB on the driver's tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from strata.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, Decimal):
        return str(v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLE) == {"extract_sample"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "avg_quality_score" in df.columns
