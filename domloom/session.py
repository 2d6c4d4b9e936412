"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings the node-table jobs rely on.  The second lets joins on (page_id, pre) reuse the
# page_id bucketing of the node table instead of shuffling it again.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("domloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """A fresh subfolder of the session's ``spark.checkpoint.dir``, which every executor can reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base.rstrip('/')}/domloom-{uuid.uuid4().hex}"
