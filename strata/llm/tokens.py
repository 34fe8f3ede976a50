"""Token ids of whole texts, with the words already met in a task remembered."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from strata.llm.common import kept

END = 1

#: Letters that fold to one letter each.
_LETTERS = "a-zA-Zà-öø-ÿÀ-ÖØ-Þß"


class WordEncoder:
    """Ids (little-endian uint32 bytes) by a tokenizer that drops white space.

    Such a tokenizer never joins what a space or line feed divides, so a text's
    ids are those of its words, one after the other. The last ``memory`` to twice
    as many words are remembered, in two generations: when the young one is
    full, it becomes the old one, and old words that occur again are young
    again. Words over 64 characters are not kept. New words are encoded many at
    a time, with a special token between them that shows where each one's ids
    end. ASCII letters are folded and a stop or comma after a letter or digit
    is set apart first, as this tokenizer does itself: fewer words to remember.
    """

    def __init__(self, path: str, memory: int = 250_000):
        # Workers are many already; threads inside each only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.memory, self.seen = Tokenizer.from_file(path), memory, {}
        self.old: dict[str, bytes] = {}
        special = [t for t in self.tokenizer.get_added_tokens_decoder().items()
                   if t[1].special and not (t[1].lstrip or t[1].rstrip or t[1].single_word)]
        self.mark, self.mark_id = (special[0][1].content, special[0][0]) if special else (None, -1)
        self.marks = [t[1].content for t in special]
        if "".join(map(str, self.tokenizer.encode("A,b. c", add_special_tokens=False).tokens)) != "a</w>,</w>b</w>.</w>c</w>":
            raise ValueError("only tokenizers that fold case and set words and marks apart")

    def _ids(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _plain(self, words: list[str]) -> list[bytes]:
        """The ids of words without special tokens."""
        if self.mark is None:
            return self._ids(words)
        out: list[bytes] = []
        for at in range(0, len(words), 512):
            text = self.mark.join(words[at:at + 512])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            data, start = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(ids == self.mark_id)).tolist():
                out.append(data[start:end])
                start = end + 4
            out.append(data[start:])
        return out

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new, distinct words."""
        special = [w for w in words if "<" in w and any(m in w for m in self.marks)]
        plain = list(set(words).difference(special)) if special else words
        found = dict(zip(plain, self._plain(plain))) if plain else {}
        found.update(zip(special, self._ids(special) if special else []))
        return found

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words; short ones are remembered."""
        if len(self.seen) >= self.memory:
            self.seen, self.old = {}, self.seen
        get = self.seen.get
        ids = [get(w) for w in words]
        again = [k for k, b in enumerate(ids) if b is None]
        if again:
            old = self.old.get
            new = []
            for k in again:
                ids[k] = old(words[k])
                if ids[k] is None:
                    new.append(k)
            learnt = self.learn([words[k] for k in new])
            for k in new:
                ids[k] = learnt[words[k]]
            self.seen.update((words[k], ids[k]) for k in again if len(words[k]) <= 64)
        return ids

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text of a string array (NULL: none)."""
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        texts = pc.replace_substring_regex(texts, f"([0-9{_LETTERS}])([.,]) ", r"\1 \2 ")
        split = pc.split_pattern(texts, " ")
        flat, starts = spelled(split.values, self.ids_of)
        at = starts[split.offsets.to_numpy()]
        return [flat[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def __call__(self, text) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


def portions(batch: pa.RecordBatch, column: int = 1, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose text column has about ``most`` bytes, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def spelled(words: pa.Array, ids_of: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a long run of words, and where each word's ids start (and all end).

    Equal words are found once per run, so ``ids_of`` sees distinct words; the
    run itself is put together by array operations.
    """
    coded = words.dictionary_encode()
    known = ids_of(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
    first = np.cumsum(sizes) - sizes
    table = np.frombuffer(b"".join(known), "<u4")
    which = coded.indices.to_numpy()
    size = sizes[which]
    starts = np.concatenate(([0], np.cumsum(size)))
    kind = np.int32 if starts[-1] < 1 << 31 and len(table) < 1 << 31 else np.int64
    at = np.repeat((first[which] - starts[:-1]).astype(kind), size)
    at += np.arange(starts[-1], dtype=kind)
    return table[at], starts


def encode_pieces(docs: DataFrame, size: int = 4096, with_ids: bool = False,
                  path: str | None = None) -> DataFrame:
    """One row per piece of at most ``size`` tokens of every row of ``docs``.

    A document is its ids and the end id; only longer ones are cut, into full
    pieces and a rest. Columns ``doc_id, piece, start, length, ids_crc32`` (and
    ``ids``, little-endian uint16), and ``uid``, which differs for every piece.
    NULL text is empty: one piece of the end id alone.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    fields = [docs.schema["doc_id"], T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("uid", T.LongType())]
    if with_ids:
        if Tokenizer.from_file(path).get_vocab_size() > 1 << 16:
            raise ValueError("ids are written in 16 bits")
        fields.append(T.StructField("ids", T.BinaryType()))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return docs.select("doc_id", "text").mapInArrow(_cutter(path, size, with_ids), schema)


def _cutter(path: str, size: int, with_ids: bool) -> Callable:
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("words", path), lambda: WordEncoder(path))
        uid = TaskContext.get().partitionId() << 33
        for b in (part for whole in batches for part in portions(whole)):
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, ids_of in enumerate(encoder.encode_all(b.column(1))):
                ids_of += end
                for n, at in enumerate(range(0, len(ids_of), 4 * size)):
                    part = ids_of[at:at + 4 * size]
                    of.append(k)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("<u2").tobytes())
            columns = {"doc_id": b.column(0).take(pa.array(of, pa.int64())),
                       "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                       "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                       "uid": pa.array(range(uid, uid + len(of)), pa.int64())}
            uid += len(of)
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
            pa.default_memory_pool().release_unused()

    return cut
