"""Published versions: readers see the old table whole, or the new one."""

import threading

import pytest
from pyspark.sql import functions as F

from strata.sinks import versions as V


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def broken(df, at=1):
    return df.withColumn("v", F.when(F.col("v") >= at, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))


def table(spark, data):
    return spark.createDataFrame(data, "g string, v long")


def test_replace_append_and_partitions(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    assert V.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        V.read(spark, root)
    V.publish(table(spark, [("a", 1), ("b", 2), (None, 3)]), root, ["g"], meta={"batch": 0})
    assert rows(V.read(spark, root)) == rows(table(spark, [("a", 1), ("b", 2), (None, 3)]))
    V.publish(table(spark, [("b", 4), ("b", 5), ("c", 6)]), root, ["g"], V.PARTITIONS)
    assert rows(V.read(spark, root)) == [("a", 1), ("b", 4), ("b", 5), ("c", 6), (None, 3)]
    m = V.publish(table(spark, [("a", 7)]), root, ["g"], V.APPEND, meta={"batch": 1})
    assert rows(V.read(spark, root)) == [("a", 1), ("a", 7), ("b", 4), ("b", 5), ("c", 6), (None, 3)]
    assert m.number == 3 and V.current(spark, root) == m and m.meta == {"batch": 1}
    plan = V.read(spark, root).where("g = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan
    with pytest.raises(ValueError):
        V.publish(table(spark, []), root, None, V.APPEND)
    with pytest.raises(ValueError):
        V.publish(table(spark, []), root, ["g"], "some")


def test_empty_tables(spark, tmp_dir):
    for parts in (None, ["g"]):
        root = f"{tmp_dir}/t{len(parts or [])}"
        V.publish(table(spark, []), root, parts)
        assert V.read(spark, root).columns == ["g", "v"] and V.read(spark, root).count() == 0
        V.publish(table(spark, [("a", 1)]), root, parts, V.APPEND)
        V.publish(table(spark, []), root, parts, V.PARTITIONS)
        # Without partitions the one partition there is has no new rows.
        assert V.read(spark, root).count() == 1
        V.publish(table(spark, []), root, parts)
        assert V.read(spark, root).count() == 0


def test_failed_write_leaves_the_old_version(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    V.publish(table(spark, [("a", 0)]), root)
    before = V.current(spark, root)
    with pytest.raises(Exception, match="stop"):
        V.publish(broken(spark.range(0, 90, 1, 9).select(F.lit("x").alias("g"), F.col("id").alias("v"))), root)
    assert V.current(spark, root) == before and rows(V.read(spark, root)) == [("a", 0)]
    V.publish(table(spark, [("b", 0)]), root)
    assert rows(V.read(spark, root)) == [("b", 0)]


def test_reader_keeps_its_version_during_refreshes(spark, tmp_dir):
    root, seen, stop = f"{tmp_dir}/t", [], threading.Event()
    whole = lambda k: spark.range(0, 400, 1, 4).select(F.lit(f"v{k}").alias("g"), F.col("id").alias("v"))
    V.publish(whole(0), root)
    held = V.read(spark, root)

    def reader():
        while not stop.is_set():
            seen.append(V.read(spark, root).agg(F.count("v"), F.min("g"), F.max("g")).first())

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for k in range(1, 5):
            V.publish(whole(k), root, keep=6)
    finally:
        stop.set()
        thread.join()
    assert seen and all(n == 400 and lo == hi for n, lo, hi in seen)
    assert held.agg(F.max("g")).first()[0] == "v0"


def test_second_writer_is_refused(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    V.publish(table(spark, [("a", 1)]), root)
    old = V.current(spark, root)
    V.publish(table(spark, [("b", 1)]), root)
    monkeypatch.setattr(V, "current", lambda *_: old)
    with pytest.raises(RuntimeError, match="another writer"):
        V.publish(table(spark, [("c", 1)]), root)
    monkeypatch.undo()
    assert rows(V.read(spark, root)) == [("b", 1)]


def test_vacuum_and_compaction(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    want = []
    for k in range(6):
        data = [("a", k), ("b", k)] if k % 2 else [("a", k)]
        want += data
        V.publish(table(spark, data), root, ["g"], V.APPEND, meta={"batch": k})
    assert len(V._numbers(V.Folder(spark, root))) == 2
    assert len(V.current(spark, root).leaves) == 9
    stays = [x for x in V.current(spark, root).leaves if x.startswith("g=b")]
    m = V.compact(spark, root, max_leaves=4)
    assert len(m.leaves) == 4 and m.meta == {"batch": 5} and set(stays) <= set(m.leaves)
    assert rows(V.read(spark, root)) == sorted(want)
    assert V.compact(spark, root, max_leaves=4) is None
    V.vacuum(spark, root, keep=1)
    files = V.Folder(spark, root).found(f"data/*/{V.VERSION}=*")
    assert len(files) == 4 and rows(V.read(spark, root)) == sorted(want)
