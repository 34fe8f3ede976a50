import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import id_output, queries, sos_packing
from strata.llm.tokens import WordEncoder, encode_pieces
from tests.llm.conftest import DOCS, SF, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_equal_whole_texts(tokenizer):
    rng = random.Random(2)
    parts = ["a", "b", "the", "The", ".", ",", "'s", "'S", " ", "\n", "\t", "é", "İ", "Σ", "ſ", "<|startoftext|>",
             "<|ENDOFTEXT|>", "1", "漢", "x" * 70, "\x1c", " ", "é", "!"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(6000)] + [None, ""]
    encoder = WordEncoder(PATH, memory=500)     # small: its generations turn over often
    for at in range(0, len(texts), 40):
        some = texts[at:at + 40]
        for t, ids in zip(some, encoder.encode_all(pa.array(some, pa.string()))):
            want = tokenizer.encode(t, add_special_tokens=False).ids if t else []
            assert np.frombuffer(ids, "<u4").tolist() == want, t


def check_pieces(got, texts, tokenizer, size):
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    for r in got.itertuples():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length <= size and r.start == r.piece * size
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert got.groupby("doc_id").length.sum().to_dict() == {k: len(v) for k, v in ids.items()}


def check_places(got, size):
    got = got.sort_values(["sequence_id", "offset"])
    group = got.groupby("sequence_id").length
    assert (group.cumsum() - got.length == got.offset).all() and group.sum().max() <= size


def test_op10_against_brute_force(spark, small, tokenizer):
    got = queries.op10_best_fit_packing(spark, SF).toPandas()
    check_pieces(got, small["documents"].set_index("doc_id").text.to_dict(), tokenizer, 4096)
    check_places(got, 4096)
    assert got.sequence_id.nunique() <= 1.03 * got.length.sum() / 4096 + 2


def brute_sum_of_squares(lengths, size):
    gaps, out = [], []
    for s in lengths:
        def cost(after):
            counts = {}
            for g in after:
                if 0 < g:
                    counts[g] = counts.get(g, 0) + 1
            return sum(c * c for c in counts.values())
        options = [(cost(gaps[:k] + [g - s] + gaps[k + 1:]), g, k) for k, g in enumerate(gaps) if g >= s]
        options.append((cost(gaps + [size - s]), size, len(gaps)))
        _, gap, k = min(options, key=lambda o: (o[0], o[1]))
        gaps[k:k + 1] = [gap - s]
        out.append(gap)
    return len(gaps), out


def test_place_minimises_the_sum_of_squares():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 17, rng.integers(1, 40))
        sequence, offset = sos_packing.place(lengths, 16)
        bins, gaps = brute_sum_of_squares(lengths.tolist(), 16)
        assert sequence.max() + 1 == bins and (16 - offset).tolist() == gaps


def test_best_fit_decreasing_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = rng.integers(1, 33, rng.integers(1, 60))
        home, room, brute = id_output.best_fit_decreasing(lengths, 32), [], np.zeros(len(lengths), int)
        for k in np.argsort(-lengths, kind="stable"):
            fits = [(r, i) for i, r in enumerate(room) if r >= lengths[k]]
            if not fits:
                room.append(32)
            i = min(fits)[1] if fits else len(room) - 1
            room[i] -= lengths[k]
            brute[k] = i
        assert sorted(np.bincount(home, lengths)) == sorted(np.bincount(brute, lengths))


def test_op7_round_trip(spark, small, tokenizer):
    parts = {}
    for r in queries.op7_id_output(spark, SF).collect():
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == 4096 and len(positions) == r.n_tokens == r.cu_seqlens[-1]
        assert (ids[r.n_tokens:] == id_output.PAD).all() and len(r.segments) == len(r.cu_seqlens) - 1
        for s, a, b in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (positions[a:b] == np.arange(b - a)).all()
            parts.setdefault(s.doc_id, []).append((s.start, ids[a:b].tolist()))
    texts = small["documents"].set_index("doc_id").text
    assert set(parts) == set(texts.index)
    for k, own in parts.items():
        assert sum((ids for _, ids in sorted(own)), []) == tokenizer.encode(texts[k], add_special_tokens=False).ids + [1]


def test_odd_rows(spark, odd_docs, no_docs, tokenizer):
    got = sos_packing.pack_documents(spark, odd_docs, 512).toPandas()
    check_places(got, 512)
    ends = got[got.length + got.start == 1]
    assert len(ends) == 4                                  # "", blanks and two NULL texts
    whole = odd_docs.toPandas().text.map(lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1)
    assert got.length.sum() == whole.sum() and got.doc_id.isna().any()
    packed = id_output.write_sequences(spark, odd_docs, 512).toPandas()
    assert packed.n_tokens.sum() == whole.sum()
    assert sos_packing.pack_documents(spark, no_docs).count() == 0
    assert id_output.write_sequences(spark, no_docs).count() == 0


def test_many_groups_and_large_ids(spark):
    big = 2 ** 60 + 1
    docs = spark.createDataFrame(rows([f"some words number {k}" for k in range(50)] + [None], first=big), DOCS)
    got = sos_packing.pack_documents(spark, docs, 64, group_rows=10).toPandas()
    check_places(got, 64)
    assert set(got.doc_id) == set(range(big, big + 51))
    pieces = encode_pieces(docs, 64, with_ids=True).toPandas()
    assert pieces.uid.is_unique and (pieces.ids.map(len) == 2 * pieces.length).all()


def test_empty_texts_make_groups_and_ties_have_one_order(spark):
    docs = spark.range(4000).selectExpr("cast(id as decimal(20,0)) AS doc_id", "CASE WHEN id % 2 = 0 THEN '' END AS text")
    sent = lambda df: sorted((r.sequence_id, tuple(int(s.doc_id) for s in r.segments)) for r in df.collect())
    got = sent(id_output.write_sequences(spark, docs, 64, group_bytes=64_000))
    assert sorted(i for _, ids in got for i in ids) == list(range(4000))
    assert len({sequence >> 32 for sequence, _ in got}) == 4             # 256,000 bytes of rows
    assert got == sent(id_output.write_sequences(spark, docs, 64, group_bytes=64_000))
    assert all(len(ids) <= 64 for _, ids in got)
