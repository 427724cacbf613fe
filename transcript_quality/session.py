"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "transcript-quality",
                  driver_memory: str | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_CONF, checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    The location is ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only when
    neither is set on a local master (tests) is a fresh temporary folder made the context's
    checkpoint folder, so that every later call agrees."""
    sc = spark.sparkContext
    base = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tq-ckpt-"))
        base = sc.getCheckpointDir()
    return "/".join([base.rstrip("/"), *parts]) if parts else base


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """The session's settings with ``conf`` on top; what was there is put back at the end."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check that works for any Hadoop file system, not only the driver's disk."""
    if path.startswith("/") and os.path.exists(path):
        return True
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
