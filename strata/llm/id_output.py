"""Token ids in binary, packed by best fit decreasing (operator 7).

Texts are tokenized, documents longer than a sequence are cut losslessly, and
the pieces of a packing group are placed longest first into the open sequence
of least sufficient room, found by descent in a segment tree over room sizes.
A sequence is written as one row: the id matrix row (little-endian uint32,
padded), the cumulative segment lengths, and position ids that restart at 0
with every segment (little-endian uint16).

Ids travel once, in the shuffle that deals pieces by hash over groups of about
``group_bytes`` of text and rows; a group is one Arrow table in one task, and
there are as many groups as the input needs. The pieces of a group are packed in
the order of their numbers, so a task that runs again packs the same sequences.

Defined results: an empty table gives no row; NULL or empty text is a segment
of the end id alone; repeated rows are packed as often as they occur. ``doc_id`` may be of any type.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm.tokens import encode_pieces

PAD = 0
ROW_BYTES = 64               # what a row counts beside its text, as its place and segment take memory


class RoomTree:
    """Segment tree over room sizes 1..size: which have an open sequence."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at = room + self.width
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) of the least room that is at least ``need``."""
        at = need + self.width
        if not self.count[at]:
            # Up to the first subtree on the right that is not empty, then down its left side.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.width
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, size: int) -> np.ndarray:
    """Sequence number of every piece."""
    tree, out, opened = RoomTree(size), np.zeros(len(lengths), np.int64), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        room, at = tree.take(need) or (size, opened)
        opened += at == opened
        out[k] = at
        if room > need:
            tree.add(room - need, at)
    return out


def packed_rows(lengths: np.ndarray, ids: list[bytes], members: list, size: int, first: int) -> list[dict]:
    """The sequences of one group, one row each."""
    home = best_fit_decreasing(lengths, size)
    order = np.lexsort((np.arange(len(home)), home))
    cuts = np.flatnonzero(np.diff(home[order], prepend=-1))
    rows = []
    for n, at in enumerate(np.split(order, cuts[1:]) if len(order) else []):
        own = lengths[at]
        body = np.frombuffer(b"".join(ids[k] for k in at), "<u2").astype("<u4").tobytes()
        positions = np.concatenate([np.arange(x, dtype="<u2") for x in own])
        rows.append({
            "sequence_id": first + n, "n_tokens": int(own.sum()),
            "ids": body + np.full(size - len(body) // 4, PAD, "<u4").tobytes(),
            "cu_seqlens": np.concatenate(([0], np.cumsum(own))).tolist(),
            "positions": positions.tobytes(),
            "segments": [members[k] for k in at]})
    return rows


def write_sequences(spark: SparkSession, docs: DataFrame, size: int = 4096, path: str | None = None,
                    group_bytes: int = 12 << 20) -> DataFrame:
    """One row per packed sequence of the token ids of ``docs``."""
    if not 0 < size <= 1 << 16:
        raise ValueError("positions are written in 16 bits: size must be 1 to 65536")
    # Rows weigh, too: a group has a bounded number of pieces however short the texts are.
    charge = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)
    groups = max(1, -(-(docs.select(F.sum(charge).alias("n")).first().n or 0) // group_bytes))
    pieces = encode_pieces(docs, size, with_ids=True, path=path).withColumn(
        "_group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    segment = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                            T.StructField("start", T.LongType())])
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids", T.BinaryType()), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("positions", T.BinaryType()), T.StructField("segments", T.ArrayType(segment))])
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    out = pa.schema([
        ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())), ("positions", pa.binary()),
        ("segments", pa.list_(pa.struct([("doc_id", id_type), ("piece", pa.int32()), ("start", pa.int64())])))])

    def packer(key, rows):
        # Shuffled rows come in any order: equal lengths are placed by number.
        rows = rows.sort_by("uid")
        members = rows.select(["doc_id", "piece", "start"]).to_pylist()
        packed = packed_rows(rows["length"].to_numpy(), rows["ids"].to_pylist(), members, size,
                             key[0].as_py() << 32)
        return pa.Table.from_pylist(packed, schema=out)

    return pieces.groupBy("_group").applyInArrow(packer, schema)
