"""Quality classifier: a factorisation machine (operator 8).

Features of a text: hashed words (term counts, scaled to unit length), a few
structure statistics and its length (the only metadata used). The machine adds
to a linear model the interactions of all feature pairs through rank-``k``
factors, computed in linear time as half of (sum of v x)^2 - sum of v^2 x^2.

Defined results: NULL or empty text has no words and zero statistics, and gets
the score of the bias and length features alone. Without a labelled row every
score is 0.5; with labels of one class, the machine learns that class. Equal
texts get equal scores; only ``text`` is read when scoring.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import free_name

STATISTICS = 13
_SYMBOLS = "#*$%&|<>!"
_FEATURES = T.StructType([
    T.StructField("words", T.BinaryType()), T.StructField("weights", T.BinaryType()),
    T.StructField("statistics", T.BinaryType()), T.StructField("label", T.IntegerType())])


@dataclass
class Machine:
    bits: int
    bias: float
    linear: np.ndarray    # (2^bits + STATISTICS,)
    factors: np.ndarray   # (2^bits + STATISTICS, rank)


class Featurizer:
    """Text -> (word buckets, their weights, statistics). Remembers the
    buckets of up to ``memory`` words, then starts over."""

    def __init__(self, bits: int, memory: int = 300_000):
        self.mask, self.memory, self.seen = (1 << bits) - 1, memory, {}

    def bucket(self, word: str) -> int:
        b = zlib.crc32(word.encode("utf-8", "replace")) & self.mask
        if len(word) <= 40:
            if len(self.seen) >= self.memory:
                self.seen.clear()
            self.seen[word] = b
        return b

    def __call__(self, text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = text if isinstance(text, str) else ""
        words = text.split()
        n, chars = len(words), max(1, len(text))
        seen = self.seen
        if n:
            raw = np.array([seen[w] if w in seen else self.bucket(w) for w in words], dtype=np.int64)
            ids, counts = np.unique(raw, return_counts=True)
            weights = (counts / math.sqrt(float((counts * counts).sum()))).astype(np.float32)
            repeats = int((raw[1:] == raw[:-1]).sum())
            top = int(counts.max())
        else:
            ids, weights, repeats, top = np.zeros(0, np.int64), np.zeros(0, np.float32), 0, 0
        m = max(1, n)
        symbols = [min(1.0, text.count(s) / m) for s in _SYMBOLS]
        lines = text.count("\n") + 1
        stats = np.array([
            min(1.0, math.log1p(n) / 10), min(1.0, chars / m / 20), min(1.0, sum(symbols)),
            symbols[5], symbols[8],                       # table bars, exclamation marks
            sum(map(str.isupper, words)) / m, repeats / m, top / m, len(ids) / m,
            min(1.0, lines / m), sum(map(str.isdigit, words)) / m,
            min(1.0, text.count(".") / m * 4), min(1.0, math.log1p(len(text)) / 14)],
            dtype=np.float32)
        return ids, weights, stats


def raw_score(m: Machine, ids: np.ndarray, weights: np.ndarray, stats: np.ndarray) -> float:
    """Log odds by the sum-of-squares identity, linear in the features present."""
    at = np.concatenate([ids, np.arange(STATISTICS) + (1 << m.bits)])
    x = np.concatenate([weights, stats])
    vx = m.factors[at] * x[:, None]
    return float(m.bias + m.linear[at] @ x + 0.5 * ((vx.sum(0) ** 2).sum() - (vx * vx).sum()))


def fit(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], bits: int, rank: int = 6,
        epochs: int = 6, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, one example at a time (driver, bounded input)."""
    rng = np.random.default_rng(seed)
    size = (1 << bits) + STATISTICS
    m = Machine(bits, 0.0, np.zeros(size, np.float32),
                rng.normal(0, 0.05, (size, rank)).astype(np.float32))
    g_bias, g_lin, g_fac = 1e-6, np.full(size, 1e-6, np.float32), np.full((size, rank), 1e-6, np.float32)
    tail = np.arange(STATISTICS) + (1 << bits)
    rows = [(np.concatenate([i, tail]), np.concatenate([w, s]), y) for i, w, s, y in examples]
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            v = m.factors[at]
            vx = v * x[:, None]
            s = vx.sum(0)
            z = m.bias + m.linear[at] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum())
            d = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, float(z))))) - y
            gl = d * x + decay * m.linear[at]
            gf = d * (x[:, None] * s - v * (x * x)[:, None]) + decay * v
            g_bias += d * d
            g_lin[at] += gl * gl
            g_fac[at] += gf * gf
            m.bias -= rate * d / math.sqrt(g_bias)
            m.linear[at] -= rate * gl / np.sqrt(g_lin[at])
            m.factors[at] = v - rate * 0.5 * gf / np.sqrt(g_fac[at])
    return m


def learn(docs: DataFrame, labels: DataFrame, bits: int = 14, max_rows: int = 6000,
          **settings) -> Machine | None:
    """Fit on at most ``max_rows`` documents of ``labels`` (``doc_id, label``; 0 or 1).

    The sample is the labelled documents of smallest id hash, the same on every
    run; all ids and labels are read to choose it. It is small enough to
    broadcast, so texts are not shuffled, and features are computed on the
    executors: only bounded vectors reach the driver. No usable row: None.
    """
    ids = docs.select("doc_id").distinct()
    sample = (labels.where(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int").alias("label"))
              .join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # Of repeated ids the least label and the text of least hash: the same on every run.
    mark = F.struct(F.xxhash64("text").alias("hash"), F.col("text"), F.col("label"))
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
             .groupBy("doc_id").agg(F.min(mark).alias("one")).select("one.text", "one.label"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Featurizer(bits)
        for b in batches:
            out = []
            for text, y in zip(b["text"], b["label"]):
                ids, weights, stats = make(text)
                out.append((ids.astype("<i4").tobytes(), weights.tobytes(), stats.tobytes(), int(y)))
            yield pd.DataFrame(out, columns=_FEATURES.names)

    sent = texts.mapInPandas(features, _FEATURES).collect()
    if not sent:
        return None
    rows = sorted((bytes(r.words), bytes(r.weights), bytes(r.statistics), r.label) for r in sent)
    examples = [(np.frombuffer(a, "<i4").astype(np.int64), np.frombuffer(b, np.float32),
                 np.frombuffer(c, np.float32), y) for a, b, c, y in rows]
    return fit(examples, bits, **settings)


def scorer(machine: Machine | None):
    """A text -> score (0 to 1) column function."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = Featurizer(machine.bits) if machine else None
        for texts in batches:
            if machine is None:
                yield pd.Series([0.5] * len(texts), dtype="float64")
                continue
            z = [raw_score(machine, *make(t)) for t in texts]
            yield pd.Series([1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, v)))) for v in z],
                            dtype="float64")

    return score


def predict(docs: DataFrame, machine: Machine | None) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the score; its name comes second."""
    name = free_name(docs, "_quality")
    return docs.withColumn(name, scorer(machine)(F.col("text"))), name


def keep_good(docs: DataFrame, machine: Machine | None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, columns unchanged."""
    scored, name = predict(docs, machine)
    return scored.where(F.col(name) >= threshold).select(*docs.columns)
