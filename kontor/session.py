"""Session construction and the shared scratch folder.

Jobs that need to cut lineage or stage data write under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared filesystem on a real
cluster).  Only when that setting is absent -- local runs and tests --
do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # map-side partial aggregation must stay on: hot keys collapse before the shuffle
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "kontor",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only when the session has none.

    Local sessions (tests) get a fresh temporary folder; a cluster session
    without ``spark.checkpoint.dir`` is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            # executors could not reach a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="kontor-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_DROPPING, _LOCK = {"open": 0, "before": "false"}, threading.Lock()
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """The shuffle files of what is planned and run inside go when it has ended, not when the
    driver happens to collect its garbage: a job of many steps needs the disk of its largest
    one, not of all of them.  For writes and aggregates whose result is read once."""
    with _LOCK:  # writers at once: the last one out puts the setting back
        if not _DROPPING["open"]:
            _DROPPING["before"] = spark.conf.get(DROP_SHUFFLES, "false")
            spark.conf.set(DROP_SHUFFLES, "true")
        _DROPPING["open"] += 1
    try:
        yield
    finally:
        with _LOCK:
            _DROPPING["open"] -= 1
            if not _DROPPING["open"]:
                spark.conf.set(DROP_SHUFFLES, _DROPPING["before"])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
