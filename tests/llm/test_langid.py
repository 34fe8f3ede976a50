import math
import re

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from strata.llm import langid, queries
from tests.llm.conftest import DOCS, PROSE, SF, rows


def learned(spark):
    texts = [(k, " ".join([PROSE[lang]] * (4 + k % 3)) + f" {k}", lang, "s", 1)
             for k, lang in enumerate(["en", "de"] * 20)]
    return langid.learn(spark.createDataFrame(texts, DOCS))


def test_held_out_accuracy_and_columns(spark, small):
    got = queries.op1_language_id(spark, SF).toPandas().merge(small["documents"], on="doc_id")
    held = got[got.held_out]
    assert len(got) == len(small["documents"]) and len(held) > 20
    assert (held.lang_pred == held.lang).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_prediction_reads_only_the_text(spark, small):
    model = learned(spark)
    docs = spark.createDataFrame(rows([PROSE["de"], PROSE["en"]]), DOCS)
    a, name = langid.predict(docs, model)
    b, _ = langid.predict(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "doc_id": F.lit(9)}), model)
    assert [r[name] for r in a.collect()] == [r[name] for r in b.collect()]
    assert [r[name].lang for r in a.collect()] == ["de", "en"]


def test_whole_long_text_counts(spark):
    model = learned(spark)
    docs = spark.createDataFrame(rows([PROSE["en"] + " " + " ".join([PROSE["de"]] * 200)]), DOCS)
    out, name = langid.predict(docs, model)
    assert out.first()[name].lang == "de"


def test_odd_rows(spark, odd_docs, no_docs):
    model = learned(spark)
    out, name = langid.predict(odd_docs, model)
    got = out.collect()
    assert len(got) == 12
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert r[name].lang == "und" and not r[name].accepted and r[name].score == 0
        else:
            assert r[name].lang in ("en", "de") and 0 <= r[name].score <= 1
    kept = langid.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.where("text is null").count() == 0
    assert langid.keep_identified(no_docs, model).count() == 0


def test_nothing_and_one_language_learned(spark, no_docs):
    docs = spark.createDataFrame(rows(["a few words", None]), DOCS)
    none, name = langid.predict(docs, langid.learn(no_docs))
    assert [r[name].lang for r in none.collect()] == ["und", "und"]
    one = langid.learn(spark.createDataFrame(rows([" ".join([PROSE["en"]] * 5)] * 3), DOCS))
    got, name = langid.predict(docs, one)
    assert [(r[name].lang, r[name].accepted) for r in got.collect()] == [("en", True), ("und", False)]


class Same:
    """Every language takes as many bytes."""
    langs = ["a", "b"]

    def __call__(self, plain):
        return [len(plain), len(plain)]


def test_ties_are_rejected():
    assert langid.classify_one("abc def", Same()) == ("a", 0.5, 0.0, False)
    assert langid.classify_one("abc def", Same(), langid.Curve([9.0, 0, 0, 0], 0.5))[3] is False


def brute_force(model, text):
    """Language, margin in bytes and length by a loop over blocks and whole dictionaries."""
    plain = " ".join(re.findall(r"[^\W\d_]+", text.lower()))
    if not any(c.isalpha() for c in plain):
        return "und", 0.0, 0
    totals = {}
    for lang, data in model.dictionaries.items():
        size = lambda b: len(zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(
            data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False,
            write_dict_id=False).compress(b))
        raw, total = plain.encode(), 0.0
        for block in (raw[k:k + 4096] for k in range(0, len(raw), 4096)):
            if len(block) < 512 and model.carriers:
                total += max(0.0, sum(size(block + b" " + c) - size(c) for c in model.carriers) / len(model.carriers))
            else:
                total += size(block)
        totals[lang] = total
    (least, best), (second, _) = sorted((t, lang) for lang, t in totals.items())[:2]
    return best, second - least, len(raw)


def test_all_texts_against_brute_force(spark, small):
    docs = spark.createDataFrame(small["documents"][["doc_id", "text", "lang"]])
    model = langid.learn(docs.where("doc_id % 4 <> 2"), rows_per_language=15)
    assert model.curve is not None and 0 < model.curve.least <= langid.SURE
    out, name = langid.predict(docs, model)
    got = {r.doc_id: r[name] for r in out.collect()}
    for r in small["documents"].sample(80, random_state=1).itertuples():
        lang, ahead, size = brute_force(model, r.text)
        assert got[r.doc_id].lang == lang
        if lang != "und":
            score = 1 / (1 + math.exp(-sum(w * x for w, x in zip(
                model.curve.weights, (1, math.log1p(ahead), ahead / size, math.log1p(size))))))
            assert got[r.doc_id].score == pytest.approx(score)
            assert got[r.doc_id].accepted == (ahead > 0 and score >= model.curve.least)


def test_wrong_predictions_are_rejected_far_more_often():
    """Short and mixed texts that no dictionary holds: rejected and score tell right from wrong."""
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs[docs.text.str.len() > 400]
    texts = [(r.lang, langid.letters_only(r.text)[:3000]) for r in docs.itertuples()]
    model = langid.Model({x: " ".join(t for k, (y, t) in enumerate(texts) if y == x and k % 3 == 0).encode()[:100_000]
                          for x in ("de", "en", "es", "fr")}, [])
    model.curve = langid.learned_curve(model, texts[1::3])
    sizes, right, wrong = langid.Sizes(model), [], []
    for k, (lang, t) in enumerate(texts[2::3]):
        other = next(t2 for y, t2 in texts[k:] + texts if y != lang)
        for text, hard in ((t, False), (f"{t[:300]} {other[:280]}", True), (t[40:56], True)):
            got, score, _, accepted = langid.classify_one(text, sizes, model.curve)
            (right if got == lang else wrong).append((accepted, score, hard))
    whole = [x for x in right if not x[2]]
    share = lambda rows: sum(not x[0] for x in rows) / len(rows)
    assert len(wrong) >= 10 and share(wrong) > 3 * share(right) and share(whole) < 0.05
    # On nearly even mixtures, too, a right prediction has the higher score more often than not.
    r, w = (np.array([x[1] for x in rows]) for rows in (right, wrong))
    assert (r[:, None] > w[None, :]).mean() > 0.65


def test_curve_needs_wrong_predictions(spark):
    model = learned(spark)
    assert langid.learned_curve(model, [("en", PROSE["en"])] * 5) is None
    assert model.curve is None or 0 < model.curve.least <= langid.SURE


def short_messages(lang, n):
    """Different texts of under 200 characters."""
    words = PROSE[lang].split()
    return [" ".join(words[k % len(words):] + words[:k % len(words)])[:40 + k % 60] + f" {k}" for k in range(n)]


def test_short_labelled_texts_are_learned(spark):
    docs = spark.createDataFrame(rows(short_messages("en", 60)) + rows(short_messages("de", 60), "de", 100), DOCS)
    model = langid.learn(docs)
    assert sorted(model.dictionaries) == ["de", "en"] and len(model.carriers) == 2 * langid.CARRIERS
    assert all(len(c) > 50 for c in model.carriers)
    kept = langid.keep_identified(docs, model).collect()
    out, name = langid.predict(docs, model)
    got = [(r.lang, r[name].lang) for r in out.collect()]
    assert len(kept) > 100 and sum(a == b for a, b in got) > 110


def test_short_language_beside_a_long_one(spark):
    long = [" ".join([PROSE["en"]] * (4 + k % 3)) + f" {k}" for k in range(120)]
    docs = spark.createDataFrame(rows(long + short_messages("en", 30)) + rows(short_messages("de", 300), "de", 900)
                                 + rows(["12", "", "!!!", "3.5"] * 40, "de", 2000), DOCS)
    model = langid.learn(docs)
    assert sorted(model.dictionaries) == ["de", "en"]
    only_long = langid.learn(spark.createDataFrame(rows(long), DOCS))
    assert model.dictionaries["en"] == only_long.dictionaries["en"]      # long texts come first
    out, name = langid.predict(spark.createDataFrame(rows([PROSE["de"], PROSE["en"]]), DOCS), model)
    assert [r[name].lang for r in out.collect()] == ["de", "en"]


def test_short_texts_fill_up(spark):
    docs = rows([PROSE["en"] * 4, PROSE["en"] * 5 + " x"] + short_messages("en", 50))
    model = langid.learn(spark.createDataFrame(docs, DOCS), rows_per_language=20)
    data = model.dictionaries["en"].decode()
    assert langid.letters_only(PROSE["en"] * 4) in data and len(data) > len(PROSE["en"]) * 9 + 300
    few = langid.learn(spark.createDataFrame(rows(["just one"]), DOCS))
    assert few.dictionaries == {"en": b"just one"} and few.carriers == []


def test_only_starts_of_texts_reach_the_driver(spark, monkeypatch):
    sizes = []

    def counted(self):
        got = collect(self)
        sizes.append(max(len(v.encode() if isinstance(v, str) else v) for r in got for v in r
                         if isinstance(v, (str, bytes, bytearray))))
        return got

    long = [" ".join([PROSE["de"]] * 3000) + f" {k}" for k in range(3)] + ["漢字ü " * 40_000]
    docs = spark.createDataFrame(rows(long, "de"), DOCS)
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", counted)
    model = langid.learn(docs)
    small = langid.learn(docs, dictionary_bytes=400)
    assert sizes and max(sizes) <= 131_072 // 20 + 3
    assert len(model.dictionaries["de"]) > 2 * 6000 and len(small.dictionaries["de"]) <= 41
    assert [len(c.decode()) for c in model.carriers] == [langid.CARRIER_CHARACTERS] * 2 and small.carriers == model.carriers
