"""SentencePiece encoding and decoding by a weighted transducer (operator 4).

Compiled from a BPE model into one machine: the normaliser (an arc that reads a
space and writes U+2581, arcs that copy every other character, an arc that
reads nothing and writes the dummy prefix), the pieces (a trie, an arc at every
end of a piece) and the byte fallback (an arc from any character that is no
piece to the ids of its UTF-8 bytes). States are the last piece written. The
arc from piece a to piece b weighs 0 if merging the text of ab by the model's
merge priorities ends in exactly [a, b], and infinity if not; a fallback arc
weighs ``BYTES`` more. A sequence of pieces is the model's encoding iff all its
neighbours pass, so the shortest path of the input composed with the machine,
in the tropical semiring (minimum over arcs, sum along a path), is the encoding.
Arc weights are computed when first met and remembered.

White space starts chunks and no piece has it further in, so chunks compose
independently; chunks already met in a task are remembered (bounded).

Defined results: NULL or empty text has no ids and decodes to the empty text.
Characters without a piece become their UTF-8 bytes. Decoding is exact but for
U+2581 in the text, which the model itself reads as a space.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import kept
from strata.llm.tokens import portions, spelled

SPACE = "▁"
BYTES = 1                     # weight of a character written as bytes


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the top-level fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


class Model:
    """What the transducer needs of a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = dict(_fields(sp.serialized_model_proto()))
        trainer, normalizer = dict(_fields(proto[2])), dict(_fields(proto[3]))
        if trainer.get(3, 1) != 2:
            raise ValueError("only BPE models")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only identity normalisers that keep and escape white space")
        self.dummy_prefix = bool(normalizer.get(3, 1))
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in range(n) if not special[i]}
        self.ids = {p: sp.piece_to_id(p) for p in self.rank}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(sp.is_byte(i) for i in self.bytes):
            raise ValueError("only models with byte fallback")
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("only models whose pieces have white space in front")
        # Decoding: the bytes that an id stands for.
        self.text = [b""] * n
        for p, i in self.ids.items():
            self.text[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.bytes):
            self.text[i] = bytes([b])


class Transducer:
    def __init__(self, model: Model, memory: int = 250_000, weight: Callable[[str], int] = lambda piece: 0):
        self.model, self.memory = model, memory
        self.normal = {" ": SPACE}                   # the normaliser's arcs that change a character
        self.writes = str.maketrans(self.normal)
        # A node: its children, and the arc that ends there (what it writes, what it weighs).
        self.trie: dict[str, list] = {}
        for p in model.rank:
            children = self.trie
            for c in p:
                node = children.setdefault(c, [{}, None])
                children = node[0]
            node[1] = p, weight(p)
        self.arcs: dict[tuple[str, str], bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Line feeds that are in no piece cut chunks as white space does.
        lf = "" if any("\n" in p for p in model.rank) else "\n"
        white = "".join([SPACE, *(c for c, to in self.normal.items() if to == SPACE)])
        self.cut = re.compile(f"[{white}]*[^{white}{lf}]+|[{white}]+" + ("|\n" if lf else ""))

    def merged(self, text: str) -> list[str]:
        """Merge symbols by priority, leftmost first: the meaning of the model."""
        s, rank = list(text), self.model.rank
        while len(s) > 1:
            best = min(((rank[a + b], k) for k, (a, b) in enumerate(zip(s, s[1:])) if a + b in rank),
                       default=None)
            if best is None:
                break
            k = best[1]
            s[k:k + 2] = [s[k] + s[k + 1]]
        return s

    def finite(self, a: str, b: str) -> bool:
        """Whether the arc from piece a (or the start, '') to piece b weighs 0."""
        known = self.arcs.get((a, b))
        if known is None:
            if len(self.arcs) >= 4 * self.memory:
                self.arcs.clear()
            known = self.arcs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def written(self, chunk: str, start: bool = False) -> str:
        """What the normaliser's arcs write; at the start of a text the dummy prefix, too."""
        prefix = SPACE if start and self.model.dummy_prefix else ""
        return prefix + chunk.translate(self.writes)

    def shortest_path(self, chunk: str, start: bool = False) -> list[str]:
        """The pieces of the least weight through chunk o machine.

        A prefix has one last piece of finite weight at most, so the states at a
        position are one. An arc that cannot lower the weight at its end is not
        looked at further; whether it is finite is found out only then."""
        return self.path_through(self.written(chunk, start))

    def path_through(self, symbols: str) -> list[str]:
        """``shortest_path`` of what the normaliser has written."""
        n = len(symbols)
        least: list[float] = [0, *[math.inf] * n]    # weight of the best path to a position
        last: list[str] = [""] * (n + 1)             # and its last piece
        finite, known, roots = self.finite, self.arcs.get, self.trie
        for i, c in enumerate(symbols):
            so_far = least[i]
            if so_far == math.inf:
                continue
            a, node = last[i], roots.get(c)
            if (node is None or node[1] is None) and so_far + BYTES < least[i + 1] and finite(a, c):
                least[i + 1], last[i + 1] = so_far + BYTES, c         # byte fallback
            k = i + 1
            while node is not None:
                node, arc = node
                if arc is not None:
                    b, weight = arc
                    if so_far + weight < least[k]:
                        passes = known((a, b))
                        if finite(a, b) if passes is None else passes:
                            least[k], last[k] = so_far + weight, b
                if k == n:
                    break
                node = node.get(symbols[k])
                k += 1
        path, at = [], n
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of what the normaliser has written."""
        out = self.old.get(chunk)
        if out is None:
            ids: list[int] = []
            for p in self.path_through(chunk):
                known = self.model.ids.get(p)
                ids += [known] if known is not None else [self.model.bytes[b] for b in p.encode()]
            out = struct.pack(f"<{len(ids)}i", *ids)
        if len(chunk) <= 64:
            if len(self.chunks) >= self.memory:      # two generations of the latest chunks
                self.chunks, self.old = {}, self.chunks
            self.chunks[chunk] = out
        return out

    def encode(self, text) -> bytes:
        """Ids as little-endian int32."""
        if not isinstance(text, str) or not text:
            return b""
        get, make = self.chunks.get, self.chunk_ids
        return b"".join([get(c) or make(c) for c in self.cut.findall(self.written(text, True))])

    def word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of words that a space stands before."""
        get, make = self.chunks.get, self.chunk_ids
        return [b"".join([get(c) or make(c) for c in self.cut.findall(SPACE + w)]) for w in words]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of a string array. Where words have one space
        between, as nearly everywhere, equal words are composed once. Texts with
        other white space, or with U+2581 (which joins it), are composed whole."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.or_(pc.or_(pc.equal(texts, ""), pc.match_substring(texts, "  ")),
                     pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " ")))
        odd = pc.or_(odd, pc.match_substring(texts, SPACE))
        if not self.model.dummy_prefix:
            odd = pc.or_(odd, True)
        split = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        flat, starts = spelled(split.values, self.word_ids)
        at = starts[split.offsets.to_numpy()].tolist()
        even = iter([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])])
        rest = iter(texts.filter(odd).to_pylist())
        return [self.encode(next(rest)) if o else next(even) for o in odd.to_pylist()]

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.model.text.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        out = text.decode("utf-8", "replace")
        return out[1:] if self.model.dummy_prefix and out[:1] == " " else out


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, n_ids, decoded_sha256, round_trip`` of every row of ``docs``."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.LongType()), T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(_encoder(path), schema)


def _encoder(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = kept(("pieces", path), lambda: Transducer(Model(path)))
        for whole in batches:
            for b in portions(whole):
                texts = b.column(1).to_pylist()
                ids = machine.encode_all(b.column(1))
                sizes = [len(x) // 4 for x in ids]
                decoded = [machine.decode(x) for x in ids]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column(0),
                    "ids": pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                        pa.array(np.frombuffer(b"".join(ids), "<i4"))),
                    "n_ids": pa.array(sizes, pa.int64()),
                    "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                    "round_trip": pa.array([d == (t or "") for d, t in zip(decoded, texts)])})

    return run
