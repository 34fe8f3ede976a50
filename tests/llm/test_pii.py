import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import boosting, pii, queries
from tests.llm.conftest import DOCS, SF, rows


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(digits(m.group())) <= 15]


def test_base_spans_by_brute_force():
    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice("a1@.+-( )9 %04é") for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(t) == brute(t), t


def test_query_against_brute_force(spark, small):
    got = queries.op3_pii(spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(small["documents"])
    for r in small["documents"].itertuples():
        base = brute(r.text)
        text = pii.listed(base)
        assert got.base_sha256[r.doc_id] == hashlib.sha256(text.encode()).hexdigest()
        assert [got[f"n_{k}"][r.doc_id] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert {s for s in text.split(",") if s} <= set(got.spans[r.doc_id].split(","))


def test_method_adds_loose_spellings_and_leaves_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    detector = pii.learn(docs)
    found = lambda t: [t[a:b] for _, a, b in pii.detect(t, detector)[1]]
    assert found("write to bob [at] example [dot] org now") == ["bob [at] example [dot] org"]
    assert found("the host 10[.]0[.]0[.]17 is") == ["10[.]0[.]0[.]17"]
    assert found("call 713-555-8702 today") == ["713-555-8702"]
    assert found("mail jane at mail dot org please") == ["jane at mail dot org"]
    assert found("call 5551234567 now") == ["5551234567"]
    # Base matches that failed their check.
    assert found("pay 12 4111 1111 1111 1111 34 soon") == ["4111 1111 1111 1111"]
    assert found("see 300.10.0.0.17 here") == ["10.0.0.17"]
    assert found("ring +1 (269) 555-3296 2024-01-02 17 then") == ["+1 (269) 555-3296"]
    for clean in ("it crashed at the dot com peak", "order 5551234567 was", "a 8490294829394200 b", "a 8151544138611138 b",
                  "a 7893477555515722 b", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15",
                  "on 2024-01-02 12", "pages 12-14-16", "version 3.10", "it cost 1,250.00 and 17", "no data here"):
        assert found(clean) == []


def test_learning_is_repeatable_and_calibrated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = pii.learn(docs), pii.learn(docs.repartition(5))
    assert a.thresholds == b.thresholds and all(t >= 0.5 for t in a.thresholds.values())
    assert pii.calibrate(np.array([.9, .8, .1]), np.array([0., 0., 0.]), .97) == 2.0


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = ((x[:, 0] > .5) & (x[:, 1] > .3)).astype(float)
    p = boosting.fit(x, y).probability(x)
    assert ((p > .5) == (y > .5)).mean() > .95
    assert boosting.fit(x, np.ones(800)).probability(x).min() > .9


def test_odd_rows(spark, odd_docs, no_docs):
    detector = pii.learn(odd_docs)
    got = odd_docs.select("doc_id", pii.spans_column(detector)(F.col("text")).alias("f")).select("doc_id", "f.*")
    assert got.count() == 12 and got.agg(F.sum("n_email")).first()[0] == 1
    clean = pii.redacted(odd_docs, detector)
    assert clean.columns == odd_docs.columns and clean.count() == 12
    assert clean.where("text like '%<EMAIL>'").count() == 1 and clean.where("text is null").count() == 2
    none = pii.learn(no_docs)
    assert pii.redacted(no_docs, none).count() == 0
    text = "mail a@b.co or +1 (269) 555-3296."
    out = pii.redacted(spark.createDataFrame(rows([text, None, ""]), DOCS), none).orderBy("doc_id").collect()
    assert out[0].text == "mail <EMAIL> or <PHONE>." and out[0].n_chars == len(out[0].text)
    assert out[1].text is None and out[2].text == ""


def test_long_runs_are_linear():
    for t in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" * 50_000, "1 " * 100_000):
        pii.base_spans(t)
        pii.proposals(t[:20_000])


def test_every_proposal_passes_the_gate():
    always = pii.fit([])
    always.thresholds = dict.fromkeys(pii.KINDS, 0.0)
    text = "write to jane.doe [ at ] mail [ dot ] org now"
    assert [text[a:b] for _, a, b in pii.detect(text, always)[1]] == ["jane.doe [ at ] mail [ dot ] org"]
    assert pii.redact(text, always) == "write to <EMAIL> now"
    between = [f"{o}{i}{w}{j}{c}" for o in "[({" for c in "])}" for w in ("at", "AT", "dot", "DOT")
               for i in ("", " ") for j in ("", " ")]
    ats = ["@"] + [b for b in between if "at" in b.lower()]
    dots = ["."] + [b for b in between if "dot" in b.lower()]
    for at in ats:
        for dot in dots:
            found = pii.proposals(f"by jane{at}mail {dot} org, ")
            assert found and all(pii._ANY.search(f"by jane{at}mail {dot} org, "[a:b]) for _, a, b in found)
    for t in ("10[.]0[.]0[.]17", "4111.1111.1111.1111", "713-555-8702", "5551234567", "by jane at mail dot org, ",
              "j dot doe AT mail.co DOT uk"):
        assert all(pii._ANY.search(t[a:b]) for _, a, b in pii.proposals(t)) and pii.proposals(t)


def test_training_rows_are_bounded(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(pii, "fit", lambda found, **settings: fitted.append(found))
    texts = ["call 713-555-8702 or 10.0.0.17 " * 400, "mail a@b.co now", "on 2024-01-02 12"]
    docs = spark.createDataFrame(rows(texts), DOCS)
    pii.learn(docs)
    pii.learn(docs, max_rows=50)
    pii.learn(docs.repartition(5), max_rows=50)
    whole, some, again = ([repr(e) for e in found] for found in fitted)
    each = sorted(repr((list(map(float, x)), y)) for t in texts for x, y in pii.examples(t))
    assert sorted(repr(e[:2]) for e in fitted[0]) == each and len(whole) > 800
    assert len(some) == 50 and some == again and set(some) <= set(whole)


def test_card_windows_by_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("0123456789 12-") for _ in range(rng.randint(10, 60)))
        want = set()
        for m in pii._LOOSE_CARD.finditer(t):
            groups = [g.span() for g in re.finditer("[0-9]+", t[:m.end()]) if g.start() >= m.start()]
            places = [k for a, b in groups for k in range(a, b)]
            if len(places) <= 19:
                want.add(("card", *m.span()))
            firsts, lasts = {a for a, _ in groups}, {b - 1 for _, b in groups}
            for n in range(13, min(20, len(places))):
                for i in range(len(places) - n + 1):
                    window = places[i:i + n]
                    if (window[0] in firsts or window[-1] in lasts) and pii.luhn("".join(t[k] for k in window)):
                        want.add(("card", window[0], window[-1] + 1))
        assert set(pii._cards(t)) == want, t


def test_taken_stretches_by_brute_force():
    rng = random.Random(2)
    for _ in range(500):
        draw = lambda: (lambda a: ("x", a, a + rng.randint(1, 9)))(rng.randint(0, 60))
        spans = [draw() for _ in range(rng.randint(0, 6))]
        taken = pii.Taken(spans)
        for _ in range(20):
            s = draw()
            over = any(s[1] < b and a < s[2] for _, a, b in spans)
            assert taken.overlaps(s) == over
            if not over:
                taken.add(s)
                spans.append(s)


def test_halves_are_split_by_text():
    row = [0.0] * len(pii.features("a@b.co", ("email", 0, 6)))
    one_text = [(row, 1, 7), (row, 0, 7)]
    assert set(pii.fit(one_text).thresholds.values()) == {2.0}        # nothing to calibrate on
    for seen in (one_text, one_text + [(row, 1, -8)]):
        assert pii.added_spans("mail jane at mail dot org", [], pii.fit(seen)) == []


def test_texts_full_of_numbers_stay_fast():
    detector = pii.fit([])
    detector.thresholds = dict.fromkeys(pii.KINDS, 0.0)     # every proposal is wanted
    for t in ("4 " * 20_000, "12 " * 10_000, "713-555-8702, " * 4_000, "x at y dot zz, " * 4_000):
        base, more = pii.detect(t, detector)
        spans = sorted(s[1:] for s in base + more)
        assert more and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_every_text_and_row_is_learned_from(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(pii, "fit", lambda found, **settings: fitted.append(found))
    texts = [f"call 713-555-{k:04d} or 10.0.0.{k % 256}, {2 * k}-{k}-17" for k in range(3500)]
    docs = spark.createDataFrame(rows(texts + texts[:700]), DOCS)
    pii.learn(docs)
    # More than 3,000 different texts and 100,000 rows; a repeated text counts once.
    want = sum(1 for t in texts for _ in pii.examples(t))
    assert len(fitted[0]) == want
    many = spark.createDataFrame(rows([f"from 10.0.{k}.7 and +1 (269) 555-{k:04d}, " * 9 for k in range(400)]), DOCS)
    found = pii.training(many).agg(F.sum("n"), F.count("n"), F.count_distinct("trains")).first()
    assert found[0] > 100_000 > found[1] and found[2] == 2


def test_spread_fit_equals_the_fit_in_memory(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    near = pii.learn(docs)
    monkeypatch.setattr(pii, "IN_MEMORY", 0)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    far = pii.learn(docs)
    assert len(near.model.trees) == 60 and far.model.base == near.model.base and far.thresholds == near.thresholds
    assert min(near.thresholds.values()) < 1
    for a, b in zip(near.model.trees, far.model.trees):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.leaf == b.leaf).all()
    assert pii.learn(docs.where("text is null")).thresholds == dict.fromkeys(pii.KINDS, 2.0)


def test_spread_thresholds_equal_those_in_memory(spark, monkeypatch):
    class ByLength:
        def probability(self, x):
            return x[:, 1] / 40

    monkeypatch.setattr(boosting, "fit_spread", lambda rows: ByLength())
    rng = random.Random(5)
    data = []
    for _ in range(400):
        kind, size = rng.randrange(3), rng.randrange(1, 40)
        data.append(([float(kind), float(size)], int(rng.random() < size / 30), False, rng.randint(1, 9)))
    got = pii.fit_spread(spark.createDataFrame(data, "x array<double>, y int, trains boolean, n long"), .9)
    want = dict.fromkeys(pii.KINDS, 2.0)
    for k, kind in enumerate(pii.KINDS):
        each = [(x, y) for x, y, _, n in data if x[0] == k for _ in range(n)]
        p, y = ByLength().probability(np.array([x for x, _ in each] or np.zeros((0, 2)))), [y for _, y in each]
        cuts = [t for t in [0.0, *p] if sum(b for a, b in zip(p, y) if a > t) >= .9 * (sum(p > t) + 1) > .9]
        if cuts:
            want[kind] = max(.5, float(np.nextafter(min(cuts), 1)))
    assert got.thresholds == want and min(want.values()) < 1


def test_rows_that_occur_twice_weigh_twice():
    rng = np.random.default_rng(4)
    x = np.floor(rng.random((300, 4)) * 30)
    y = ((x[:, 0] > 12) ^ (x[:, 2] > 20)).astype(float)
    n = rng.integers(1, 5, 300)
    a, b = boosting.fit(x, y, n), boosting.fit(np.repeat(x, n, axis=0), np.repeat(y, n))
    assert (a.probability(x) == b.probability(x)).all()
    for c, column in zip(boosting._cuts(x, n, 16), x.T):
        assert np.allclose(c, np.unique(np.quantile(np.repeat(column, n), np.arange(16) / 16)))
