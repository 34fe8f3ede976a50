"""Exact random sample of ``n`` rows (``ORDER BY rand() LIMIT n``) in one pass.

Every row draws a score of its own, equal rows too: a seeded hash of the row's
place in its source (``row_id``: file and row number), or, where a source has
none (JSON, CSV), seeded ``rand()``, which repeats when a task reads its split
again. The sample is the ``n`` smallest scores.

Each task keeps its ``n`` smallest while it reads (``smallest``: no task sorts or
spills its rows) and sends them to one of ``MERGERS`` groups of tasks, each of
which keeps its ``n`` smallest again; the last merge sees at most
``n * MERGERS`` rows, however many tasks there are. The source is read once
and nothing runs before the result is asked for. Beyond the number of rows up
to which Spark limits a window group in the task (``windowGroupLimitThreshold``),
tasks send their rows to the last merge directly.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.topn import top_k, top_n_per_group

MERGERS = 64


def score(seed: int, row_id: Sequence[str] = ()) -> Column:
    """A score per row, uniform over the signed 64-bit range."""
    if row_id:
        return F.xxhash64(F.lit(seed), *row_id)
    return ((F.rand(seed) - 0.5) * 2.0 ** 64).cast("long")


def smallest(column: str, n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: the ``n`` rows of a task with the smallest ``column`` (no
    NULLs in it). At most ``5 * n`` rows and one batch are held, and few of them are copied."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        import pyarrow.compute as pc

        def cut(held: list) -> pa.Table:
            rows = pa.concat_tables(held)
            return rows.take(pc.select_k_unstable(rows, n, [(column, "ascending")])).combine_chunks()

        kept, most, held = None, None, []
        for batch in batches:
            if most is not None:
                batch = batch.filter(pc.less(batch.column(column), most))
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) > 4 * n:
                kept = cut(([kept] if kept is not None else []) + held)
                most, held = kept.column(column)[-1] if kept.num_rows == n else None, []
        rest = ([kept] if kept is not None else []) + held
        if rest:
            yield from cut(rest).to_batches()

    return keep


def sample_rows(df: DataFrame, n: int, seed: int | None = None, where: Column | None = None,
                row_id: Sequence[str] = ()) -> DataFrame:
    """Exactly ``min(n, count)`` uniformly chosen rows of those that pass
    ``where``, fixed by ``seed``; the ``row_id`` columns are dropped."""
    seed = random.randrange(1 << 31) if seed is None else seed
    scored = df.withColumn("_r", score(seed, row_id))
    if where is not None:
        scored = scored.where(where)
    if 0 < n <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        scored = scored.mapInArrow(smallest("_r", n), scored.schema)
        scored = top_n_per_group(scored.withColumn("_m", F.spark_partition_id() % MERGERS),
                                 ["_m"], [F.col("_r")], n, rank_col="_k").drop("_m", "_k")
    return top_k(scored, [F.col("_r")], n).drop("_r", *row_id)
