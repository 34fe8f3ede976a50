import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import fm_quality as Q
from strata.llm import queries
from tests.llm.conftest import DOCS, rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op8_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_score_equals_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    m = Q.Machine(4, 0.3, rng.normal(size=16 + Q.STATISTICS), rng.normal(size=(16 + Q.STATISTICS, 3)))
    ids, weights, stats = np.array([1, 5, 9]), np.array([.2, .5, .1]), rng.random(Q.STATISTICS)
    at = [*ids, *(16 + np.arange(Q.STATISTICS))]
    x = [*weights, *stats]
    pairs = sum(m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    want = 0.3 + sum(m.linear[a] * v for a, v in zip(at, x)) + pairs
    assert Q.raw_score(m, ids, weights, stats) == pytest.approx(want)


def test_learns_an_interaction_of_words():
    make, rng = Q.Featurizer(10), np.random.default_rng(1)
    def text():
        return " ".join(w for w in ("apple", "pear", "plum", "fig") if rng.random() < .5)
    texts = [text() for _ in range(600)]
    y = [int(("apple" in t) == ("pear" in t)) for t in texts]
    m = Q.fit([(*make(t), v) for t, v in zip(texts, y)], 10, epochs=40)
    right = [(Q.raw_score(m, *make(t)) > 0) == v for t, v in zip(texts, y)]
    assert np.mean(right) > 0.9


def test_labels_of_the_held_out_part_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    a = queries.quality_machine(spark, docs, SF)
    b = Q.learn(docs.repartition(4), seen)
    assert np.array_equal(a.linear, b.linear) and np.array_equal(a.factors, b.factors)


def test_odd_rows(spark, odd_docs, no_docs):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType())])
    labels = spark.createDataFrame([(0, 1), (0, 1), (5, 0), (6, 0), (None, 1), (7, None), (99, 1)], schema)
    machine = Q.learn(odd_docs, labels)
    scored, name = Q.predict(odd_docs, machine)
    got = scored.collect()
    assert len(got) == 12 and all(0 <= r[name] <= 1 for r in got)
    assert len({r[name] for r in got if r.doc_id == 0}) == 1
    assert Q.keep_good(odd_docs, machine).columns == odd_docs.columns
    assert Q.learn(odd_docs, labels.limit(0)) is None and Q.learn(no_docs, labels) is None
    assert Q.keep_good(odd_docs, None).count() == 12 and Q.keep_good(no_docs, machine).count() == 0
    ones = Q.learn(odd_docs, labels.where("label = 1"))
    assert Q.predict(odd_docs, ones)[0].count() == 12


def test_repeated_ids_have_one_label_and_text(spark):
    """Whatever the order of the rows, the machine is the same."""
    texts = [f"{'good long prose' if k % 2 else 'click here !!!'} number {k} of the table" for k in range(60)]
    data = [(k % 40, t) for k, t in enumerate(texts)]
    marks = [(k, k % 2) for k in range(40)] + [(k, 1) for k in range(0, 40, 4)]
    machines = []
    for parts in (1, 5):
        docs = spark.createDataFrame(data[::-1 if parts == 5 else 1], "doc_id long, text string").repartition(parts)
        labels = spark.createDataFrame(marks[::-1 if parts == 5 else 1], "doc_id long, label int").repartition(parts)
        machines.append(Q.learn(docs, labels))
    one, other = machines
    assert one.bias == other.bias and (one.linear == other.linear).all() and (one.factors == other.factors).all()
