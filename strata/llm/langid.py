"""Language identification by compression (operator 1).

Each language gets a raw-content zstandard dictionary of its own text. A text
is cut into blocks, every block is compressed once per dictionary, and the
language whose dictionary gives the fewest bytes in all is chosen.

How narrow a margin to the runner-up is too narrow is learned, too: labelled
texts that no dictionary holds are classified whole, in pieces of a few lengths
and mixed with another language, and a logistic curve over the margin in bytes,
the margin per byte of text and the length gives the chance that a prediction
is right (``score``). Rejected is what scores below ``least``: the score that all
but ``REJECTED`` of the right whole texts reach, and no more than ``SURE``.

Frames of very short blocks are stored uncompressed and would tie. So a short
block is compressed in front of several carriers (bits of unseen text, the same
number of each language), and what a carrier takes by itself is subtracted.

Defined results: NULL text, or text without a letter: ``und``, score 0,
rejected. No language learned: ``und``. One language learned: that language.
Ties: the alphabetically first language, rejected. Too few texts to learn the
curve: a share of the weights 2^-bytes is the score, and relative margins below
0.001 are rejected. Repeated rows get equal results; only ``text`` is read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm.common import free_name

RESULT = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("margin", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

_WORDS = re.compile(r"[^\W\d_]+")


#: Carriers per language, their length, and the bytes below which a block is short.
CARRIERS, CARRIER_CHARACTERS, SHORT = 2, 125, 512
#: Characters of a text that is learned before shorter ones.
LONG = 200


#: Of right whole held-out texts, the share that may be rejected, and the score that always suffices.
REJECTED, SURE = 0.005, 0.9
#: Lengths of the pieces that the curve is learned from, and shares of the first of two languages.
PIECES, MIXED = (16, 32, 64, 128, 256), (0.55, 0.65, 0.75, 0.85)


@dataclass
class Curve:
    """Chance that a prediction is right, and the least that is accepted."""
    weights: list[float]
    least: float

    def __call__(self, ahead: float, size: int) -> float:
        z = sum(w * x for w, x in zip(self.weights, facts(ahead, size)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


@dataclass
class Model:
    dictionaries: dict[str, bytes]
    carriers: list[bytes]
    curve: Curve | None = None


def facts(ahead: float, size: int) -> tuple[float, ...]:
    """What the curve reads: the margin in bytes, by the byte of text, and the length."""
    return 1.0, math.log1p(ahead), ahead / max(1, size), math.log1p(size)


def letters_only(text: str) -> str:
    """Lower-cased runs of letters, one space between: what is compressed."""
    return " ".join(_WORDS.findall(text.lower()))


def learn(rows: DataFrame, rows_per_language: int = 100,
          dictionary_bytes: int = 131_072, checked_per_language: int = 200) -> Model:
    """A raw dictionary and carriers per language from ``rows`` (columns ``text``, ``lang``).

    The fit reads every row but keeps a bounded sample: per language the
    ``rows_per_language`` rows of smallest text hash (equal texts count once),
    each giving at most ``dictionary_bytes / 20`` bytes, the last few carriers. Texts of
    ``LONG`` characters come first; shorter ones with a letter fill up what these leave.
    The curve is learned from the next ``checked_per_language`` rows, cut the same way.
    Rows without text or language are not used. Texts are cut before they leave the
    executors; a language costs the driver and each worker its dictionary, so the number
    of languages is the caller's to bound.
    """
    share = max(1, dictionary_bytes // 20)
    # A share with its last character whole, and enough for a carrier.
    kept_bytes = max(share + 3, 4 * (50 + CARRIER_CHARACTERS))

    @F.pandas_udf(T.BinaryType())
    def start(texts: pd.Series) -> pd.Series:
        return pd.Series([letters_only(t).encode()[:kept_bytes] for t in texts], dtype=object)

    known = (rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
             .select("lang", F.xxhash64("text").alias("h"), (F.length("text") < LONG).alias("short"), "text")
             .where(~F.col("short") | F.col("text").rlike(r"\p{L}")).drop("text").distinct())
    # First among 64 shares of a language, so that a common one is no single task's.
    shares = Window.partitionBy("lang", F.pmod("h", F.lit(64))).orderBy("short", "h")
    first = Window.partitionBy("lang").orderBy("short", "h")
    wanted = rows_per_language + checked_per_language
    picked = (known.withColumn("n", F.row_number().over(shares)).where(F.col("n") <= wanted)
              .withColumn("n", F.row_number().over(first)).where(F.col("n") <= wanted)
              .select("lang", "h", "n"))
    # At most that many hashes a language: small enough to broadcast.
    sample = (rows.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
              .withColumn("h", F.xxhash64("text"))
              .join(F.broadcast(picked), ["lang", "h"])
              .dropDuplicates(["lang", "h"])
              .select("lang", "h", "n", (F.length("text") < LONG).alias("short"), start("text").alias("start"))
              .orderBy("lang", "h").collect())
    parts: dict[str, tuple[list[str], list[str]]] = {}
    checked: list[tuple[str, str]] = []
    for r in sample:
        plain = r.start.decode(errors="ignore")            # the cut may split the last character
        if plain and r.n > rows_per_language:
            checked.append((r.lang, plain))
        elif plain:
            parts.setdefault(r.lang, ([], []))[r.short].append(plain)
    model = Model({}, [])
    for lang, (long, short) in sorted(parts.items()):
        texts, carriers = held_out(long, short)
        data = b" ".join(t.encode()[:share] for t in texts)
        model.dictionaries[lang] = data[-dictionary_bytes:]
        model.carriers += [c.encode() for c in carriers]
    model.curve = learned_curve(model, checked)
    return model


def learned_curve(model: Model, checked: list[tuple[str, str]]) -> Curve | None:
    """The curve of texts with known languages; None where one language is learned
    or no prediction is wrong, so that there is nothing to learn from."""
    if len(model.dictionaries) < 2 or len(checked) < 20:
        return None
    sizes_of = Sizes(model)
    others = {lang: [t for other, t in checked if other != lang] for lang in model.dictionaries}

    def judged(lang: str, plain: str) -> tuple[tuple[float, ...], bool]:
        best, ahead = sizes_of.first(plain)
        return facts(ahead, len(plain.encode())), best == lang

    whole, harder = [], []
    for k, (lang, plain) in enumerate(checked):
        whole.append(judged(lang, plain))
        size = PIECES[k % len(PIECES)]
        at = (len(plain) - size) // 2
        if at > 0:
            harder.append(judged(lang, plain[at:at + size]))
        if others.get(lang):
            other, share = others[lang][k % len(others[lang])], MIXED[k % len(MIXED)]
            n = min(len(plain), len(other), 2000)
            harder.append(judged(lang, f"{plain[:int(share * n)]} {other[:n - int(share * n)]}"))
    rows = [r for r in whole + harder if any(r[0][1:])]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    if not 0 < y.mean() < 1:
        return None
    w = np.zeros(x.shape[1])
    for _ in range(50):                                    # Newton's steps, with a little shrinkage
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    curve = Curve(w.tolist(), 0.0)
    right = [float(1.0 / (1.0 + np.exp(-np.clip(np.dot(f, w), -30, 30)))) for f, ok in whole if ok]
    curve.least = min(SURE, float(np.quantile(right, REJECTED))) if right else SURE
    return curve


def held_out(long: list[str], short: list[str]) -> tuple[list[str], list[str]]:
    """The texts of a dictionary (what is cut first stands first) and carriers
    from texts that it does not hold: long ones, or short ones joined (half at most)."""
    if len(long) > CARRIERS or not short:
        kept = max(1, len(long) - CARRIERS)
        return short + long[:kept], [t[50:50 + CARRIER_CHARACTERS] for t in long[kept:]]
    kept, joined = len(short), ""
    while 2 * kept > len(short) + 1 and len(joined) < CARRIERS * CARRIER_CHARACTERS:
        kept -= 1
        joined += short[kept] + " "
    pieces = (joined[k * CARRIER_CHARACTERS:(k + 1) * CARRIER_CHARACTERS].strip() for k in range(CARRIERS))
    return short[:kept] + long, [p for p in pieces if p]


class Sizes:
    """Compressed bytes of a text by language."""

    def __init__(self, model: Model, level: int = 6, block_bytes: int = 4096):
        self.langs, self.block_bytes = sorted(model.dictionaries), block_bytes
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(model.dictionaries[lang],
                                              dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_checksum=False, write_content_size=False,
                write_dict_id=False).compress)
        self.carriers = [(k, [len(c(k)) for c in self.coders]) for k in model.carriers]

    def __call__(self, plain: str) -> list[float]:
        data = plain.encode()
        sizes = [0.0] * len(self.coders)
        for at in range(0, len(data), self.block_bytes):
            block = data[at:at + self.block_bytes]
            short = self.carriers and len(block) < SHORT
            for k, compress in enumerate(self.coders):
                if short:
                    mean = sum(len(compress(block + b" " + c)) - alone[k]
                               for c, alone in self.carriers) / len(self.carriers)
                    sizes[k] += max(0.0, mean)
                else:
                    sizes[k] += len(compress(block))
        return sizes

    def first(self, plain: str) -> tuple[str, float]:
        """The language of fewest bytes, and how many it is ahead."""
        sizes = self(plain)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        return self.langs[best], min(s for k, s in enumerate(sizes) if k != best) - sizes[best]


def classifier(model: Model, level: int = 6, block_bytes: int = 4096,
               min_margin: float = 0.001):
    """A text -> (lang, score, margin, accepted) column function.

    ``margin`` is (runner-up bytes - best bytes) / best bytes over the whole text.
    ``score`` is the chance by the model's curve, and texts below its ``least`` are
    rejected; without a curve it is the best language's share of the weights
    2^-bytes, and margins below ``min_margin`` are rejected.
    """
    @F.pandas_udf(RESULT)
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizes_of = Sizes(model, level, block_bytes)
        for texts in batches:
            yield pd.DataFrame([classify_one(t, sizes_of, model.curve, min_margin)
                                for t in texts], columns=RESULT.names)

    return classify


def classify_one(text, sizes_of: Sizes, curve: Curve | None = None, min_margin: float = 0.001):
    langs = sizes_of.langs
    plain = letters_only(text) if isinstance(text, str) else ""
    if not langs or not any(map(str.isalpha, plain)):
        return "und", 0.0, 0.0, False
    if len(langs) == 1:
        return langs[0], 1.0, 1.0, True
    sizes = sizes_of(plain)
    best = min(range(len(sizes)), key=sizes.__getitem__)
    ahead = min(s for k, s in enumerate(sizes) if k != best) - sizes[best]
    margin = ahead / max(1.0, sizes[best])
    if curve is not None:
        score = curve(ahead, len(plain.encode()))
        return langs[best], score, margin, ahead > 0 and score >= curve.least
    score = 1.0 / sum(math.exp(-min(700.0, (s - sizes[best]) * math.log(2))) for s in sizes)
    return langs[best], score, margin, margin >= min_margin


def predict(docs: DataFrame, model: Model, **settings) -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of RESULT; its name comes second."""
    name = free_name(docs, "_language")
    return docs.withColumn(name, classifier(model, **settings)(F.col("text"))), name


def keep_identified(docs: DataFrame, model: Model, **settings) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, columns unchanged."""
    scored, name = predict(docs, model, **settings)
    return scored.where(F.col(name)["accepted"]).select(*docs.columns)
