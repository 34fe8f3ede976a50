"""Best-fit packing by sums of squares (operator 10).

A piece goes where the sum, over residual gaps, of the squared counts of open
sequences with that gap becomes smallest: moving a sequence from gap ``g`` to
``g - s`` changes the sum by 2 (N[g - s] - N[g]) + 2, opening one by
2 N[size - s] + 1. The state of a packer is one count and one stack of open
sequences per gap.

Pieces are dealt by hash over packers of about ``group_rows`` pieces each, as
many packers as the input needs, so no task grows with the input. A packer
tries its pieces in hash order and in falling length and keeps the order that
needs fewer sequences. It leaves a few dozen part-filled sequences, far under one in a hundred.

Defined results: an empty table gives no row; NULL or empty text is one piece
of one token; repeated rows are packed as often as they occur; a full piece
has a sequence of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.tokens import encode_pieces
from strata.session import scratch_path


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the order given."""
    counts = np.zeros(size + 1, np.int64)      # open sequences by gap; 0 and size stay 0
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    never = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        before, after = counts[s:], counts[:size - s + 1]
        change = 2 * (after - before) + 2
        change[0] -= 1                          # a closed sequence is not counted
        change = np.where(before > 0, change, never)
        change[-1] = 2 * int(counts[size - s]) + 1 if s < size else 0    # a new sequence
        gap = int(change.argmin()) + s
        if gap == size:
            at = opened
            opened += 1
        else:
            at = stacks[gap].pop()
            counts[gap] -= 1
        sequence[k], offset[k] = at, size - gap
        if gap > s:
            stacks[gap - s].append(at)
            counts[gap - s] += 1
    return sequence, offset


def pack(spark: SparkSession, pieces: DataFrame, size: int = 4096,
         group_rows: int = 65_536) -> DataFrame:
    """``pieces`` (columns ``uid``, ``length`` and any others; a written table)
    with ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    groups = max(1, -(-pieces.count() // group_rows))
    schema = T.StructType(pieces.schema.fields + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def packer(key, rows):
        lengths, shuffled = rows["length"].to_numpy(), np.argsort(rows["_order"].to_numpy(), kind="stable")
        falling = shuffled[np.argsort(-lengths[shuffled], kind="stable")]
        best = min(([o, *place(lengths[o], size)] for o in (shuffled, falling)),
                   key=lambda t: t[1].max(initial=-1))
        sequence, offset = np.empty_like(best[1]), np.empty_like(best[2])
        sequence[best[0]], offset[best[0]] = best[1] + (key[0].as_py() << 32), best[2]
        return (rows.select(columns).append_column("sequence_id", pa.array(sequence))
                .append_column("offset", pa.array(offset)))

    return (pieces.withColumn("_order", F.xxhash64("uid"))
            .withColumn("_group", F.pmod("_order", F.lit(groups)))
            .groupBy("_group").applyInArrow(packer, schema))


def pack_documents(spark: SparkSession, docs: DataFrame, size: int = 4096,
                   path: str | None = None, group_rows: int = 65_536) -> DataFrame:
    """Token pieces of ``docs`` with their sequence and place in it."""
    pieces = encode_pieces(docs, size, path=path)
    out = scratch_path(spark, "pieces")
    pieces.write.parquet(out)                   # tokenized once, counted and packed from there
    return pack(spark, spark.read.schema(pieces.schema).parquet(out), size, group_rows).drop("uid")
