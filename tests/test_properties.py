"""Property-based checks of rules and operators against small Python models."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions.rules import bands, null_outside, upper_bands
from strata.operators.numbering import number_within

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

doubles = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([0.0, 30.0, 1800.0]),
                    st.floats(min_value=-100, max_value=2000, allow_nan=False))


def spark_le(a, b):
    """Spark ordering for doubles: NaN is above every number (and equal to NaN)."""
    if math.isnan(a):
        return math.isnan(b)
    return True if math.isnan(b) else a <= b


def spark_lt(a, b):
    return not spark_le(b, a)


def model_null_outside(x, lo, hi, lo_open):
    if x is None:
        return None
    low_ok = spark_lt(lo, x) if lo_open else spark_le(lo, x)
    return x if low_ok and spark_le(x, hi) else None


@SETTINGS
@given(st.lists(doubles, min_size=1, max_size=40))
def test_null_outside_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(null_outside("x", 30, 1800, lo_open=True)).collect()]
    want = [model_null_outside(v, 30, 1800, True) for v in values]
    assert [None if g is None else ("nan" if math.isnan(g) else g) for g in got] == \
        [None if w is None else ("nan" if math.isnan(w) else w) for w in want]


@SETTINGS
@given(st.lists(doubles, min_size=1, max_size=40))
def test_bands_first_match(spark, values):
    thresholds = [(0.8, "a"), (0.4, "b")]
    limits = [(120.0, "s"), (600.0, "m")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [tuple(r) for r in df.select(bands("x", thresholds, "z"),
                                       upper_bands("x", limits, "l")).collect()]

    def band(v):
        if v is None:
            return "z"
        for lo, label in thresholds:
            if spark_le(lo, v):
                return label
        return "z"

    def upper(v):
        if v is None:
            return "l"
        for hi, label in limits:
            if spark_le(v, hi):
                return label
        return "l"

    assert got == [(band(v), upper(v)) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20)), min_size=0, max_size=200),
       st.integers(1, 9))
def test_number_within_equals_row_number(spark, rows, parts):
    # Group 0 is made hot by repeating its rows.
    rows = rows + [(0, o) for _, o in rows]
    df = spark.createDataFrame(rows, "g int, o int").withColumn("id", F.monotonically_increasing_id())
    df = df.repartition(parts).cache()
    try:
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o", "id")))
        got = number_within(df, ["g"], [F.col("o"), F.col("id")], "rn")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        df.unpersist()


@SETTINGS
@given(st.integers(0, 3000), st.integers(1, 400), st.integers(1, 9), st.integers(0, 10**6))
def test_sample_rows_exact_for_any_size(spark, rows, n, parts, seed):
    from strata.operators.sample import sample_rows, score
    df = spark.range(rows).repartition(parts)
    got = sorted(r.id for r in sample_rows(df.withColumn("k", F.col("id")), n, seed=seed, row_id=["k"]).collect())
    assert len(got) == min(n, rows) and len(set(got)) == len(got)
    brute = df.withColumn("_r", score(seed, ["id"])).orderBy("_r").limit(n)
    assert got == sorted(r.id for r in brute.collect())
    assert sample_rows(spark.range(rows), n, seed=seed).count() == min(n, rows)
