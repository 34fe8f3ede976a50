"""Session helpers: sensible defaults for local runs, and the shared scratch root.

On a cluster the session is created by the platform; nothing here overrides
settings that are already present.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only when the key is not set yet (cluster config wins).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Settings replaced when they still hold Spark's built-in default. Generated
# methods above 8000 bytes of bytecode are never JIT-compiled by HotSpot, so
# a wide whole-stage-codegen stage would run interpreted (4x slower, measured
# on silver); at 8000 Spark falls back to per-operator code instead (Spark
# docs recommend this value on HotSpot).
JIT_CONF = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000")}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    for key, (_, value) in JIT_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set DEFAULT_CONF keys that the running session leaves unset."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    for key, (builtin, value) in JIT_CONF.items():
        if spark.conf.get(key, builtin) == builtin:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests, single machine)
    with the setting unset gets a private temporary folder; on a cluster an
    unset setting is an error, since a machine-local folder is not shared by
    the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = getattr(spark, "sparkContext", None)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster "
                             "(e.g. on the distributed file system)")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/strata-{name}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_parent(path: str) -> None:
    if is_local_path(path):
        os.makedirs(os.path.dirname(path.replace("file:", "")) or ".", exist_ok=True)
