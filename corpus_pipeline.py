"""The corpus pipeline: identify, classify, deduplicate, redact, pack.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result to the cluster's shared folder and reads it back for the
next stage, so an executor lost in one stage repeats nothing of an earlier one.
All stages but the last return the columns of ``docs``.

Defined results: empty tables pass through every stage; a NULL text has no
letter and goes in the first stage; what each stage does with ties, repeated
rows and NULL ids stands in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import fm_quality, langid, pii, queries, simhash, sos_packing
from strata.llm.common import table
from strata.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    return langid.keep_identified(docs, langid.learn(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents classified as good; the others go."""
    machine = queries.quality_machine(spark, docs, sf_dir)
    return fm_quality.keep_good(docs, machine, queries.QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(spark, docs, queries.SHINGLE_WORDS, queries.SIMHASH_BITS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs, pii.learn(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place."""
    return sos_packing.pack_documents(spark, docs, queries.SEQUENCE_TOKENS)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("best_fit_packing", best_fit_packing),
]

#: Trained and tokenizing stages have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
