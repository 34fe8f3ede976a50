import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from strata.llm import queries, sp_transducer
from tests.llm.conftest import SF

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def machine():
    return sp_transducer.Transducer(sp_transducer.Model(PATH), memory=2000)


def test_encoding_and_decoding_equal_the_library(library, machine):
    rng = random.Random(0)
    pieces = [p.replace(sp_transducer.SPACE, " ") for p in machine.model.rank]
    texts = ["", " ", "  a", "a  ", "Hello  world\n a\tb é漢字 😀 <s> <0x41> ", "\n\n", "aaaaaaa", "▁x", "\x00z", " \n "]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    texts += ["".join(rng.choice("ab c\né漢😀.1 the") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += ["a▁ ▁b", "▁", " ▁", "▁ ", "a ▁b", "a▁", "▁\n▁"]
    texts += ["".join(rng.choice("▁▁ ab\né漢 the") for _ in range(rng.randint(1, 20))) for _ in range(6000)]
    for at in range(0, len(texts), 50):
        some = texts[at:at + 50]
        for t, ids in zip(some, machine.encode_all(pa.array(some + [None]))):
            want = library.encode(t)
            assert np.frombuffer(ids, "<i4").tolist() == want, t
            assert machine.decode(ids) == library.decode(want)
            assert machine.encode(t) == ids


def test_one_path_of_weight_zero(machine):
    """All segmentations of short texts: only the encoding has finite weight."""
    def paths(text, last=""):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            p = text[:k]
            if (k == 1 or p in machine.model.rank) and machine.finite(last, p):
                for rest in paths(text[k:], p):
                    yield [p, *rest]
    for text in ("▁there", "▁antiation", "aaaaa", "▁▁▁x", "▁éch"):
        assert list(paths(text)) == [machine.shortest_path(text)] == [machine.merged(text)]


def test_normaliser_and_fallback_are_arcs_with_least_weight(machine):
    assert machine.written("a b", True) == "▁a▁b" and machine.written("a b") == "a▁b"
    assert machine.shortest_path(" there", True) == machine.shortest_path("▁▁there")
    rare = "\U0001F9FF"
    assert rare not in machine.model.rank and machine.shortest_path(f"{rare}a{rare}") == [rare, "a", rare]
    assert np.frombuffer(machine.encode("a" + rare), "<i4")[1:].tolist() == [machine.model.bytes[b] for b in rare.encode()]

    # Of several finite paths the lightest one is taken, wherever its arcs come.
    class Free(sp_transducer.Transducer):
        def finite(self, a, b):
            return True

    weight = lambda p: 5 if len(p) == 1 else 2 * len(p) if p == "the" else 1 + len(p) % 3
    free = Free(machine.model, weight=weight)

    def every(text):
        return [[]] if not text else [[text[:k], *rest] for k in range(1, len(text) + 1)
                                      if text[:k] in machine.model.rank for rest in every(text[k:])]
    for text in ("there", "these", "another", "▁thethe"):
        cost = lambda path: sum(map(weight, path))
        assert cost(free.shortest_path(text)) == min(map(cost, every(text)))


def test_query(spark, small, library):
    got = queries.op4_sentencepiece(spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(small["documents"]) and got.round_trip.all()
    for r in small["documents"].itertuples():
        assert list(got.ids[r.doc_id]) == library.encode(r.text) and got.n_ids[r.doc_id] == len(got.ids[r.doc_id])


def test_odd_rows(spark, odd_docs, no_docs):
    got = sp_transducer.encode(odd_docs).toPandas()
    assert len(got) == 12 and got.round_trip.all() and (got.n_ids == 0).sum() == 3
    assert sp_transducer.encode(no_docs).count() == 0
