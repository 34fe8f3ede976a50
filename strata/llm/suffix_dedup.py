"""Repeated passages by a distributed difference-cover suffix order (operator 12).

A byte goes if it lies in a string of ``LENGTH`` (50) bytes that also starts in
a document with a smaller ``doc_id``. Suffixes of the whole corpus are never
moved; only stretches of text that can repeat are, each of them once:

1. ``blocks``: documents are written once, packed and compressed.
2. ``stretches``: every window of 50 bytes has an anchor, the least of its
   17-byte grams by hash (grams common in a sample of documents come last,
   so that a frequent line does not attract its surroundings). Neighbouring
   windows with one anchor are a stretch of 50 to 83 bytes. Equal windows have
   equal anchors at the same place. Every block sends its distinct stretches
   (anchor hash, stretch hash, least ``doc_id``) to the bucket of the anchor.
3. A bucket answers every block: the least ``doc_id`` of a stretch that others
   have as a whole, and which stretches meet unlike ones at their anchor.
4. Of the latter, one copy each is sent as text to the range of its anchor, and
   a difference-cover suffix order is built there: suffixes at positions 1 and
   2 modulo 3 are sorted by triples of six-byte letters, then by triples of the
   names (18, then 54 bytes); the remaining suffixes are sorted by their first
   byte and the name behind it and merged in by the cover; neighbours in the
   order whose prefixes of 50 bytes agree form a class with a least ``doc_id``.
5. Blocks join the answers and cut their documents.

Rows that travel are packed arrays; groups are blocks, buckets and ranges of a
size set in bytes, and there are as many as the input needs. The sample of step
2 steers only the balance: any set of common grams gives the same result.

Defined results: NULL and empty text have no byte; documents never match
themselves, nor others of the same ``doc_id``; a NULL ``doc_id`` counts as
larger than every other. Repeated rows give equal rows. Other columns are not
read. ``doc_id`` is any integer type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import kept
from strata.session import scratch_path

LENGTH, GRAM = 50, 17
NO_ID = 2 ** 63 - 1                 # stands for a NULL id
_ROUND = 1 << 16                    # window starts treated at a time: fits a core's cache
_LOW48 = np.uint64((1 << 48) - 1)
_COMMON_BITS = 20


# --- anchors and stretches ------------------------------------------------------

def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the 256 bytes, powers of an odd base and of its inverse modulo 2^64."""
    def make():
        base, inverse = 0x9E3779B97F4A7C15, 1
        for _ in range(6):
            inverse = inverse * (2 - base * inverse) % (1 << 64)
        size = _ROUND + LENGTH
        out = []
        for b in (base, inverse):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        values = np.random.default_rng(12).integers(1, 2 ** 63, 256, dtype=np.uint64)
        return values, out[0], out[1]
    return kept(("suffix_dedup_powers", _ROUND), make)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at every place, and the running sums they come from."""
    values, up, down = _powers()
    n = len(text)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[text] * up[:n], out=sums[1:])
    return _mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1]), sums


def stretches(text: np.ndarray, ends: np.ndarray, common: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """``(anchor, hash, first window, windows)`` of every stretch of ``text``,
    documents end to end; ``ends`` are their ends."""
    parts = []
    down = _powers()[2]
    for at in range(0, max(0, len(text) - LENGTH + 1), _ROUND):
        part = text[at:at + _ROUND + LENGTH - 1]
        grams, sums = gram_hashes(part)
        order = grams >> np.uint64(1)
        if common is not None:
            order |= common[grams >> np.uint64(64 - _COMMON_BITS)].astype(np.uint64) << np.uint64(63)
        least, where, reach = order, np.arange(len(order), dtype=np.int32), 1
        while reach < LENGTH - GRAM + 1:              # least gram of a window, the first of equal ones
            step = min(reach, LENGTH - GRAM + 1 - reach)
            first = least[:-step] <= least[step:]
            where = np.where(first, where[:-step], where[step:])
            least = np.where(first, least[:-step], least[step:])
            reach += step
        n = len(where)
        inside = np.ones(n, bool)                     # windows that no document end cuts
        for end in ends[np.searchsorted(ends, at, side="right"):np.searchsorted(ends, at + len(part))]:
            inside[max(0, end - at - LENGTH + 1):end - at] = False
        new = np.ones(n, bool)
        new[1:] = (where[1:] != where[:-1]) | ~inside[:-1]
        first = np.flatnonzero(new & inside)
        breaks = np.append(np.flatnonzero(new | ~inside), n)
        last = breaks[np.searchsorted(breaks, first, side="right")]
        count = last - first
        body = _mix((sums[last + LENGTH - 1] - sums[first]) * down[first]) ^ _mix(count.astype(np.uint64))
        # Least hashes are small ones: hashed again, they spread evenly over the buckets.
        parts.append((_mix(~grams[where[first]]), body, first + at, count))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


# --- packed rows ----------------------------------------------------------------

def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every number, all first bytes before all second ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(body: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    n = len(columns[0][0])
    return n.to_bytes(8, "little") + b"".join(_planes(x, w) for x, w in columns)


def unpack(body: bytes, *widths: int) -> list[np.ndarray]:
    n, at, out = int.from_bytes(body[:8], "little"), 8, []
    for w in widths:
        out.append(_numbers(body, at, n, w))
        at += n * w
    return out


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


BLOCK = "block long, ids binary, ends binary, n long, body binary"
PACKED = "block long, part int, body binary"
_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("ends", pa.binary()),
                    ("n", pa.int64()), ("body", pa.binary())])
_PACKED = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("body", pa.binary())])


def blocks_of(block_bytes: int):
    def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        squeeze, made = zstandard.ZstdCompressor(level=3), 0

        def block(ids, texts):
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            return _batch(_BLOCK, block=[task << 32 | made], ids=[np.array(ids, np.int64).tobytes()],
                          ends=[ends.tobytes()], n=[int(ends[-1])], body=[squeeze.compress(b"".join(texts))])

        ids, texts, held = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(NO_ID if i is None else i)
                texts.append(t or b"")
                held += len(texts[-1]) + 64
                if held >= block_bytes:
                    yield block(ids, texts)
                    ids, texts, held, made = [], [], 0, made + 1
        if ids:
            yield block(ids, texts)
    return pack_blocks


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    text = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=max(1, row["n"]))
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64),
            np.frombuffer(text, np.uint8))


class _Sent:
    """What a block sends: its distinct stretches in the order of their buckets."""

    def __init__(self, row: dict, common: np.ndarray | None, buckets: int):
        self.ids, self.ends, self.text = _opened(row)
        anchor, body, self.first, self.count = stretches(self.text, self.ends, common)
        self.doc = self.ids[np.searchsorted(self.ends, self.first, side="right")]
        order = np.argsort(anchor >> np.uint64(24) << np.uint64(24) | body >> np.uint64(40), kind="stable")
        for name in ("first", "count", "doc"):
            setattr(self, name, getattr(self, name)[order])
        anchor, body = anchor[order], body[order]
        self.head = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (body[1:] != body[:-1])))
                                   ) if len(anchor) else np.zeros(0, np.int64)
        self.least = np.minimum.reduceat(self.doc, self.head) if len(self.head) else self.doc
        self.anchor, self.body = anchor[self.head] & _LOW48, body[self.head] & _LOW48
        bucket = (anchor[self.head] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        self.cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def entry_of(self) -> np.ndarray:
        """Entry of every stretch."""
        sizes = np.diff(np.append(self.head, len(self.first)))
        return np.repeat(np.arange(len(self.head)), sizes)


def _sender(common: np.ndarray | None, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sent = _Sent(row, common, buckets)
                parts = np.flatnonzero(np.diff(sent.cuts))
                for some in np.array_split(parts, max(1, len(parts) // 64)):
                    bodies = [pack((sent.anchor[a:b], 6), (sent.body[a:b], 6), (sent.least[a:b], 8))
                              for a, b in ((sent.cuts[p], sent.cuts[p + 1]) for p in some)]
                    yield _batch(_PACKED, block=[row["block"]] * len(some), part=some.tolist(), body=bodies)
    return send


def _segments(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(new), np.cumsum(new) - 1


def answer(rows: pa.Table) -> pa.Table:
    """One bucket: to every block, which of its stretches other documents have."""
    sent = [unpack(b, 6, 6, 8) for b in rows["body"].to_pylist()]
    sizes = [len(s[0]) for s in sent]
    anchor, body, doc = (np.concatenate(x) for x in zip(*sent))
    doc = doc.view(np.int64)
    order = np.lexsort((body, anchor))
    a, b, d = anchor[order], body[order], doc[order]
    new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
    heads, stretch = _segments(new_anchor | np.concatenate(([True], b[1:] != b[:-1])))
    least = np.minimum.reduceat(d, heads)
    firsts, group = _segments(new_anchor[heads])
    mixed = (np.minimum.reduceat(least, firsts) != np.maximum.reduceat(least, firsts))[group]
    told_least, told_mixed = np.empty(len(d), np.int64), np.empty(len(d), bool)
    told_least[order], told_mixed[order] = least[stretch], mixed[stretch]
    out, at = [], 0
    for n in sizes:
        own = slice(at, at + n)
        said = np.flatnonzero((told_least[own] < doc[own]) | told_mixed[own])
        out.append(pack((said, 4), (told_least[own][said], 8), (told_mixed[own][said], 1)))
        at += n
    return pa.table({"block": rows["block"], "part": rows["part"], "body": pa.array(out, pa.binary())}, schema=_PACKED)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals, joined where they meet."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


SPANS, PLACES = -1, -2            # parts of what a block keeps for the last step


def _resolver(common: np.ndarray | None, buckets: int):
    """Spans of a block that whole stretches decide, and its stretches to be ordered."""
    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"block": [], "part": [], "body": []}

        def add(block, part, body):
            for name, value in zip(out, (block, part, body)):
                out[name].append(value)

        for row in left.to_pylist():
            sent = _Sent(row, common, buckets)
            least, mixed = sent.least.copy(), np.zeros(len(sent.least), bool)
            for part, body in zip(right["part"].to_pylist(), right["body"].to_pylist()):
                said, low, many = unpack(body, 4, 8, 1)
                said = said.astype(np.int64) + sent.cuts[part]
                least[said], mixed[said] = low.view(np.int64), many.astype(bool)
            entry = sent.entry_of()
            gone = sent.doc > least[entry]
            add(row["block"], SPANS, pack(*((x, 8) for x in _merged(
                sent.first[gone], (sent.first + sent.count + LENGTH - 1)[gone]))))
            open_ = ~gone & mixed[entry]
            add(row["block"], PLACES, pack((entry[open_], 4), (sent.first[open_], 8)))
            one = np.flatnonzero(open_)
            one = one[np.concatenate(([True], entry[one][1:] != entry[one][:-1]))] if len(one) else one
            parts = np.searchsorted(sent.cuts, entry[one], side="right") - 1
            for part in np.unique(parts).tolist():
                own = one[parts == part]
                sizes = sent.count[own] + LENGTH - 1
                text = b"".join(sent.text[a:a + n].tobytes() for a, n in zip(sent.first[own], sizes))
                add(row["block"], part, pack((entry[own], 4), (sent.doc[own], 8), (sizes, 1)) + text)
        return pa.table(out, schema=_PACKED)
    return resolve


# --- the difference-cover order ---------------------------------------------------

def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, from 1, of the numbers of ``key``, and an order that sorts them."""
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    in_order = key[order]
    rank[order] = np.cumsum(np.concatenate(([True], in_order[1:] != in_order[:-1]))) if len(key) else 0
    return rank, order


def _named(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_ranked`` of the rows of these columns of small numbers."""
    key, bound = columns[0], int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if bound * width >= 1 << 63:
            key = _ranked(key)[0]
            bound = len(key) + 1
        key, bound = key * width + column, bound * width
    return _ranked(key)


def difference_cover_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` (bytes), sorted by their first 54 bytes or more."""
    n = len(text)
    padded = np.zeros(n + 64, np.int64)
    padded[:n] = text
    letter = np.zeros(n, np.int64)
    for k in range(6):
        letter = letter << 8 | padded[k:k + n]
    at = np.arange(n)
    cover = np.concatenate((at[1::3], at[2::3]))
    name = np.zeros(n + 64, np.int64)
    name[cover] = _ranked(letter[cover])[0]
    for step in (6, 18):                      # sorted triples: 18 bytes, then, of the names, 54
        name[cover], order = _named(name[cover], name[cover + step], name[cover + 2 * step])
    cover = cover[order]
    width = int(name.max(initial=0)) + 1
    behind_1 = padded[:n] * width + name[1:n + 1]
    behind_2 = (padded[:n] * 256 + padded[1:n + 1]) * width + name[2:n + 2]
    rest = at[::3]
    rest = rest[np.argsort(behind_1[rest])]
    # A remaining suffix goes behind the members that are less: one at 1 modulo 3 has
    # a name one byte on, as the suffix has; one at 2 modulo 3 has it two bytes on.
    # (Keys differ from the order in the cover only among suffixes of 54 equal bytes.)
    low = sum(np.searchsorted(np.sort(behind[at[k::3]]), behind[rest]) for k, behind in ((1, behind_1), (2, behind_2)))
    low = np.maximum.accumulate(low) if len(rest) else low
    out = np.empty(n, np.int64)
    mine = np.zeros(n, bool)
    mine[low + np.arange(len(rest))] = True
    out[mine], out[~mine] = rest, cover
    return out


def window_classes(text: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows (marked in ``window``) in suffix order, and which begin a
    class: their first 50 bytes are not those of the one before."""
    order = difference_cover_order(text)
    order = order[window[order]]
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text
    word = np.zeros(n, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k:k + n]
    new = np.ones(len(order), bool)
    same = np.arange(1, len(order))
    for k in (0, 8, 16, 24, 32, 40, LENGTH - 8):
        same = same[word[order[same] + k] == word[order[same - 1] + k]]
    new[same] = False
    return order, new


def order_stretches(rows: pa.Table) -> pa.Table:
    """One range of anchors: to every block, which windows of the stretches it sent
    start in a document with a smaller id (a bit for each window)."""
    sent = []
    for body in rows["body"].to_pylist():
        n = int.from_bytes(body[:8], "little")
        sent.append([*unpack(body, 4, 8, 1), body[8 + n * 13:]])
    sizes = np.concatenate([s[2] for s in sent]).astype(np.int64)
    doc = np.concatenate([s[1] for s in sent]).view(np.int64)
    text = np.frombuffer(b"".join(s[3] for s in sent), np.uint8)
    start = np.cumsum(sizes) - sizes
    count = sizes - LENGTH + 1
    stretch = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(stretch)) - np.repeat(np.cumsum(count) - count, count) + start[stretch]
    owner = np.full(len(text), -1, np.int64)
    owner[place] = stretch
    order, new = window_classes(text, owner >= 0)
    heads, cls = _segments(new)
    own = owner[order]
    gone = doc[own] > np.minimum.reduceat(doc[own], heads)[cls]
    mask = np.zeros(len(sizes), np.uint64)
    np.bitwise_or.at(mask, own[gone], np.uint64(1) << (order[gone] - start[own[gone]]).astype(np.uint64))
    out, at = [], 0
    for entry, *_ in sent:
        said = np.flatnonzero(mask[at:at + len(entry)])
        out.append(pack((entry[said], 4), (mask[at + said], 8)))
        at += len(entry)
    return pa.table({"block": rows["block"], "part": pa.array([0] * len(out), pa.int32()),
                     "body": pa.array(out, pa.binary())}, schema=_PACKED)


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                  ("kept", pa.binary())])


def cut(left: pa.Table, right: pa.Table) -> Iterator[pa.RecordBatch]:
    """Documents of a block with their removed spans and remaining bytes."""
    for row in left.to_pylist():
        ids, ends, text = _opened(row)
        places = {"entry": np.zeros(0, np.int64), "start": np.zeros(0, np.int64)}
        first, last, masks = [], [], []
        for part, body in zip(right["part"].to_pylist(), right["body"].to_pylist()):
            if part == SPANS:
                spans = unpack(body, 8, 8)
                first.append(spans[0].astype(np.int64))
                last.append(spans[1].astype(np.int64))
            elif part == PLACES:
                entry, start = unpack(body, 4, 8)
                places = {"entry": entry.astype(np.int64), "start": start.astype(np.int64)}
            else:
                masks.append(unpack(body, 4, 8))
        if masks:
            entry, mask = (np.concatenate(x) for x in zip(*masks))
            of = np.zeros(int(max(entry.max(initial=0), places["entry"].max(initial=0))) + 1, np.uint64)
            of[entry.astype(np.int64)] = mask
            mine = of[places["entry"]]
            for k in range(LENGTH - GRAM + 1):
                hit = places["start"][(mine >> np.uint64(k) & np.uint64(1)).astype(bool)] + k
                first.append(hit)
                last.append(hit + LENGTH)
        edge = np.zeros(len(text) + 1, np.int32)
        if first:
            a, b = _merged(np.concatenate(first), np.concatenate(last))
            # Spans of neighbouring documents may touch; they are cut at the ends below.
            edge[a] += 1
            np.subtract.at(edge, b, 1)
        gone = np.cumsum(edge[:-1]) > 0
        out = {f.name: [] for f in _CUT}
        at = held = 0
        for i, end in zip(ids.tolist(), ends.tolist()):
            own = gone[at:end]
            turns = np.flatnonzero(np.diff(np.concatenate(([False], own, [False]))))
            out["doc_id"].append(None if i == NO_ID else i)
            out["n_bytes"].append(end - at)
            out["spans"].append([{"start": a, "end": b} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())])
            out["kept"].append(text[at:end][~own].tobytes())
            held += end - at
            at = end
            if held > 4 << 20:
                yield pa.table(out, schema=_CUT)
                out, held = {f.name: [] for f in _CUT}, 0
        yield pa.table(out, schema=_CUT)


def _cut_all(left: pa.Table, right: pa.Table) -> pa.Table:
    return pa.concat_tables(cut(left, right)) if left.num_rows else pa.table({f.name: [] for f in _CUT}, schema=_CUT)


# --- the operator -----------------------------------------------------------------

def common_grams(docs: DataFrame, sample_docs: int = 1000, share: float = 0.01,
                 max_grams: int = 1 << 16) -> np.ndarray | None:
    """Mark table of gram hashes found in ``share`` of about ``sample_docs`` documents
    (at most ``max_grams`` reach the driver; the table has 2^20 marks)."""
    some = docs.where(F.octet_length("text") >= LENGTH)
    every = max(1, docs.count() // sample_docs)
    some = some.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(every)) == 0).select("text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()).to_pylist():
                own = [np.unique(gram_hashes(np.frombuffer(t, np.uint8, min(len(t) - k, _ROUND), k))[0])
                       for k in range(0, max(1, len(t) - GRAM), _ROUND - GRAM + 1)]
                yield _batch(pa.schema([("g", pa.int64())]), g=np.unique(np.concatenate(own)).view(np.int64))

    counted = some.mapInArrow(grams, "g long").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    found = counted.where(F.col("n") >= max(8, share * sample_docs)).orderBy(F.desc("n"), "g").limit(max_grams)
    marks = np.zeros(1 << _COMMON_BITS, bool)
    hashes = np.array([r.g for r in found.select("g").collect()], np.int64).view(np.uint64)
    marks[hashes >> np.uint64(64 - _COMMON_BITS)] = True
    return marks


def remove_repeats(spark: SparkSession, docs: DataFrame, block_bytes: int = 8 << 20,
                   bucket_bytes: int = 2 << 20, order_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row of ``docs``: removed spans
    (byte offsets, end exclusive) and the remaining bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = common_grams(docs)

    def written(df: DataFrame, name: str, schema: str) -> DataFrame:
        path = scratch_path(spark, f"suffix-{name}")
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    blocks = written(docs.mapInArrow(blocks_of(block_bytes), BLOCK), "blocks", BLOCK)
    total = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    answers = (blocks.mapInArrow(_sender(common, buckets), PACKED)
               .groupBy("part").applyInArrow(answer, PACKED))
    resolved = written(blocks.groupBy("block").cogroup(answers.groupBy("block"))
                       .applyInArrow(_resolver(common, buckets), PACKED), "resolved", PACKED)
    to_order = resolved.where("part >= 0")
    ranges = max(1, -(-(to_order.agg(F.sum(F.octet_length("body"))).first()[0] or 0) // order_bytes))
    # Anchors next to each other share a range; a range is one suffix order.
    ordered = to_order.groupBy(F.floor(F.col("part") * F.lit(ranges) / F.lit(buckets)).alias("range")
                               ).applyInArrow(order_stretches, PACKED)
    told = resolved.where("part < 0").unionByName(ordered)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _cut_all, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(cut_docs: DataFrame) -> DataFrame:
    """Counts and the hash of the remaining bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut_docs.select("doc_id", "n_bytes", removed.alias("n_removed"),
                           F.size("spans").cast("long").alias("n_spans"),
                           F.sha2("kept", 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB: every string of 50 bytes with the least id it starts in."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {NO_ID}) AS k,
                  lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
w AS (SELECT r, k, i, substr(x, 2 * i + 1, {2 * LENGTH}) AS s
      FROM (SELECT r, k, x, unnest(range(0, length(x) // 2 - {LENGTH - 1})) AS i FROM d)),
m AS (SELECT s, min(k) AS least FROM w GROUP BY s HAVING count(*) > 1),
g AS (SELECT r, i FROM w JOIN m USING (s) WHERE k > least),
n AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM g),
h AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + {LENGTH} THEN 1 ELSE 0 END)
             OVER (PARTITION BY r ORDER BY i) AS span FROM n),
s AS (SELECT r, span, min(i) AS a, max(i) + {LENGTH} AS b FROM h GROUP BY r, span),
t AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS kept_from FROM s),
u AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_end,
             string_agg(substr(x, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS kept
      FROM t JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last_end, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN u USING (r)"""
