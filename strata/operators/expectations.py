"""Named row expectations: counters, a long report, and stream observation.

Warn semantics: the row is kept, the outcome is counted. Outcomes are
TRUE (passed), FALSE (failed) and NULL (undetermined), counted apart.
All counters are ``count_if`` aggregates, computed in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expectation_counts(rules: dict[str, Column]) -> list[Column]:
    out = []
    for name, pred in rules.items():
        out += [
            F.count_if(pred).alias(f"{name}__passed"),
            F.count_if(~pred).alias(f"{name}__failed"),
            F.count_if(pred.isNull()).alias(f"{name}__null"),
        ]
    return out


def expectation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per expectation: ``(expectation, passed, failed, undetermined)``."""
    wide = df.agg(*expectation_counts(rules))
    rows = [
        F.struct(F.lit(name).alias("expectation"),
                 F.col(f"{name}__passed").alias("passed"),
                 F.col(f"{name}__failed").alias("failed"),
                 F.col(f"{name}__null").alias("undetermined"))
        for name in rules
    ]
    return wide.select(F.inline(F.array(*rows)))


def observe_expectations(df: DataFrame, rules: dict[str, Column], name: str = "expectations",
                         observation=None) -> DataFrame:
    """Attach the counters as observed metrics (batch ``Observation`` or a stream's
    ``lastProgress['observedMetrics'][name]``) without changing the rows."""
    target = observation if observation is not None else name
    return df.observe(target, F.count(F.lit(1)).alias("rows"), *expectation_counts(rules))
