"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    divergence, fingerprints, fm_quality, html_text, id_output, langid, lexical, pii, quality_rules,
    simhash, sos_packing, sp_transducer, suffix_dedup,
)
from strata.llm.common import id_bucket, table

SEQUENCE_TOKENS = 4096
SHINGLE_WORDS, SIMHASH_BITS = 3, 2
QUALITY_THRESHOLD = 0.3


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three quarters of the labelled rows, applied to all."""
    docs = table(spark, sf_dir, "documents")
    learned = langid.learn(docs.where(id_bucket("doc_id", 4) != 2))
    found, name = langid.predict(docs.select("doc_id", "text"), learned)
    got = F.col(name)
    return found.select("doc_id", F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        got["lang"].alias("lang_pred"), got["score"].alias("score"),
                        got["margin"].alias("margin"), got["accepted"].alias("accepted"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.spans_column(pii.learn(docs))(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_transducer.encode(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(spark, table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_output.write_sequences(spark, table(spark, sf_dir, "documents"), SEQUENCE_TOKENS)


def quality_machine(spark: SparkSession, docs: DataFrame, sf_dir: str) -> fm_quality.Machine | None:
    """Learned from the labels of four fifths of the documents."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return fm_quality.learn(docs, labels.where(id_bucket("doc_id", 5) != 0))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, name = fm_quality.predict(docs, quality_machine(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         F.col(name).alias("score"),
                         (F.col(name) >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(spark, docs, SHINGLE_WORDS, SIMHASH_BITS)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sos_packing.pack_documents(spark, table(spark, sf_dir, "documents"), SEQUENCE_TOKENS)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_html_extraction, op3_pii, op4_sentencepiece, op5_fingerprints,
        op6_quality_rules, op7_id_output, op8_quality_classifier, op9_simhash,
        op10_best_fit_packing, op11_lexical_search, op12_suffix_dedup, op13_source_divergence)}

ORACLE: dict[str, str] = {
    "op6_quality_rules": quality_rules.oracle(), "op11_lexical_search": lexical.oracle(),
    "op12_suffix_dedup": suffix_dedup.oracle(), "op13_source_divergence": divergence.oracle()}
