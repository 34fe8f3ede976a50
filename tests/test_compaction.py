"""Compaction beside a running stream: each row once, whatever fails."""

import os

import pytest
from pyspark.sql import functions as F

from strata.sinks import versions as V
from strata.streaming import compaction as C
from strata.streaming.layers import start_append


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture()
def stream(spark, tmp_dir):
    """``land(first, last)`` and ``run()``: files arrive, the stream drains them one by one."""
    source, out = f"{tmp_dir}/in", f"{tmp_dir}/out"

    def land(a, b):
        spark.range(a, b, 1, 4).write.mode("append").parquet(source)

    def run():
        df = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        start_append(df, out, f"{tmp_dir}/ckpt").awaitTermination()

    return land, run, out, f"{tmp_dir}/compact"


def test_rows_once_and_files_bounded(spark, stream):
    land, run, out, root = stream
    land(0, 40)
    run()
    assert ids(C.read_output(spark, out, root)) == list(range(40))      # nothing compacted yet
    small = len(spark.read.parquet(out).inputFiles())
    assert small == 4
    assert C.compact_output(spark, out, root) is not None
    assert C.compact_output(spark, out, root) is None                    # nothing new
    assert len(C.read_output(spark, out, root).inputFiles()) == 1
    for k in range(1, 6):
        land(40 * k, 40 * k + 40)
        run()
        assert ids(C.read_output(spark, out, root)) == list(range(40 * k + 40))
        C.compact_output(spark, out, root, max_leaves=2)
        found = C.read_output(spark, out, root)
        assert ids(found) == list(range(40 * k + 40)) and len(found.inputFiles()) <= 3
    # The stream's own output is as it was: every reader of it sees every row once.
    assert ids(spark.read.parquet(out)) == list(range(240))
    downstream = spark.readStream.schema("id long").parquet(out)
    start_append(downstream, f"{out}2", f"{out}2-ckpt").awaitTermination()
    assert ids(spark.read.parquet(f"{out}2")) == list(range(240))


def test_failed_round_is_dropped(spark, stream, monkeypatch):
    land, run, out, root = stream
    land(0, 40)
    run()
    C.compact_output(spark, out, root)
    land(40, 80)
    run()
    publish = V.publish

    def broken(df, path, *a, **k):
        if path.endswith("/rows"):
            df = df.select(F.when(F.col("id") > 50, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
        return publish(df, path, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(V, "publish", broken)
        with pytest.raises(Exception, match="stop"):
            C.compact_output(spark, out, root)
    assert ids(C.read_output(spark, out, root)) == list(range(80))
    land(80, 90)
    run()
    assert C.compact_output(spark, out, root).meta == {"round": 2}
    assert ids(C.read_output(spark, out, root)) == list(range(90))


def test_target_size_sets_the_number_of_files(spark, stream):
    land, run, out, root = stream
    land(0, 4000)
    run()
    size = sum(os.path.getsize(f.replace("file://", "")) for f in spark.read.parquet(out).inputFiles())
    C.compact_output(spark, out, root, target_bytes=size // 2)
    found = C.read_output(spark, out, root)
    assert len(found.inputFiles()) in (2, 3) and ids(found) == list(range(4000))
