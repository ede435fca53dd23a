"""Session construction and the runtime settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings that can be applied to an existing session (the driver hands us
# one).  AQE re-plans at runtime: it coalesces small shuffle partitions, turns
# a sort-merge join into a broadcast join only when the *measured* shuffle
# output of one side is under the adaptive broadcast threshold, and splits
# skewed join partitions.  So broadcasts are always size-checked.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregate on the same key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_runtime_conf(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tillroll",
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session.  On a cluster, spark-submit supplies master and
    memory; see :func:`job_session`."""
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def job_session() -> SparkSession:
    """The session of a job: the active one, the one spark-submit describes
    (its master, memory and partitions are left as they are), or, started by
    plain Python, a local one."""
    active = SparkSession.getActiveSession()
    if active is None and ("PYSPARK_GATEWAY_PORT" in os.environ or "PYSPARK_SUBMIT_ARGS" in os.environ):
        active = SparkSession.builder.getOrCreate()
    return apply_runtime_conf(active) if active else build_session()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, set on the context.

    A local folder is never picked on a cluster.  Without a SparkContext
    (Spark Connect) the session setting is returned, or None.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return spark.conf.get("spark.checkpoint.dir", None)
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        sc.setCheckpointDir(d)
    return d


def default_shuffle_partitions(input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Size shuffle partitions so each holds about ``target_bytes``."""
    return max(8, -(-input_bytes // target_bytes))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files of a job, in the shared folder of :func:`checkpoint_dir`;
    only a session of one machine that names none gets a temporary one."""
    root = checkpoint_dir(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tillroll-scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
