import os
import sys

import pandas as pd
import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

PROSE = {
    "en": "the river ran past the mill and the old house where they had lived for many years",
    "de": "der Fluss lief an der Mühle vorbei und das alte Haus stand noch immer im Schatten der Bäume",
}


def rows(texts, lang="en", first=0):
    return [(first + k, t, lang, "s", None if t is None else len(t)) for k, t in enumerate(texts)]


@pytest.fixture()
def odd_docs(spark):
    """NULLs in every column, empty, blank and long texts, repeated rows, clashing extra columns."""
    prose = " ".join(f"{PROSE['en']} {k}" for k in range(12))
    data = rows([prose, prose, "", " \n\t ", None, "x" * 300_000, "word " * 60_000, "Straße 漢字 😀 a@b.co"])
    data += [data[0], (None, prose, None, None, None), (None, None, None, None, None), (None, prose, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "q") for r in data], T.StructType(
        DOCS.fields + [T.StructField("score", T.IntegerType()), T.StructField("_group", T.StringType())]))
    return df.repartition(3)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return {t: pd.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages", "labels")}
