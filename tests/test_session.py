"""Session rules: shared checkpoint folder from the session, defaults only where unset,
spreading only where asked for."""


from strata.session import apply_defaults, checkpoint_root, scratch_path
from strata.sources.files import spread_rows


def test_checkpoint_root_reads_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_root(spark) == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(configured.rstrip("/"))


def test_defaults_do_not_override_explicit_settings(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        apply_defaults(spark)
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, old)


def test_time_zone_of_a_running_session_stays(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.unset("spark.sql.session.timeZone")
    try:
        before = spark.conf.get("spark.sql.session.timeZone")
        apply_defaults(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_spreading_is_explicit(spark):
    from tests.conftest import SF_SMALL
    from strata.sources.songs import load_songs
    plain = load_songs(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plain and "CollectMetrics" not in plain
    one = spark.range(0, 1000, numPartitions=1)
    spread = spread_rows(one, 8, ["id"])
    assert spread.rdd.getNumPartitions() == 8
    assert sorted(r.id for r in spread.collect()) == list(range(1000))


def test_cluster_without_checkpoint_dir_is_an_error():
    import pytest

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Context:
        registered = None

        def getCheckpointDir(self):
            return self.registered

        def setCheckpointDir(self, path):
            Context.registered = path

    class Session:
        conf = Conf({"spark.master": "spark://cluster:7077"})
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    Session.conf.values["spark.checkpoint.dir"] = "hdfs:///shared/ckpt"
    assert checkpoint_root(Session()) == "hdfs:///shared/ckpt"
    assert Context.registered == "hdfs:///shared/ckpt"
