"""Helpers shared by the operators: reading a table, the shared folder, rows that need an identity."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that Spark hands to Python at once.  Rows are whole texts here; the default, 10,000, would be tens of megabytes.
ROWS_AT_ONCE = 500


def in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def give_back() -> None:
    """Hand freed memory back to the system: Python workers are kept for later tasks, and so would be their heaps."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(batches_to_batches):
    """The same function for mapInArrow, which gives memory back when its task ends."""

    def run(batches):
        try:
            yield from batches_to_batches(batches)
        finally:
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    in_small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only in local tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="domloom-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder: later reads survive lost executors and see the same rows."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def release(spark: SparkSession, took: float) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more, before the next step makes its own.

    py4j tells Spark what Python has dropped from a thread that looks once a second.  That is waited for after steps that
    ``took`` many seconds; of shorter ones the files go with those of the next.
    """
    gc.collect()
    time.sleep(min(1.1, took / 10))
    spark.sparkContext._jvm.System.gc()


def step(df: DataFrame) -> DataFrame:
    """``cut`` for a job of many steps: the shuffle files that ``df`` needed are deleted before later steps make theirs.

    Each of them is a file or more for every task, however few rows there are; Spark itself deletes them only when the
    driver happens to collect its garbage.  So ``df`` should be an expression that nothing else keeps.
    """
    spark, began = df.sparkSession, time.monotonic()
    kept = cut(df)
    del df
    release(spark, time.monotonic() - began)
    return kept


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows that ``build`` gives, kept in the shared folder; all that ``build`` itself kept there is deleted.

    For decisions (ids, marks), which are small beside the texts that went into them.
    """
    context, base, began = spark.sparkContext, shared_folder(spark), time.monotonic()
    before = context.getCheckpointDir() or base  # another scratch folder, if this is part of a larger step
    folder = f"{base}/scratch-{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)
    try:
        rows = build()
    finally:
        context.setCheckpointDir(before)
    kept = cut(rows)
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    del rows
    release(spark, time.monotonic() - began)
    return kept


def text_bytes(column: str = "text"):
    """UTF-8 bytes of the text, a null text as empty."""
    return F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")
