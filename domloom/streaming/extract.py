"""The same extraction over page files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from domloom.schema import PAGES
from domloom.sources.shred import shred


def read_page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of pages from a folder (or glob) of parquet files."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_nodes(pages: DataFrame) -> DataFrame:
    """Node rows of a page stream.  Stateless, so filters on the result stream on as they are."""
    return shred(pages)


def run_extract(pages: DataFrame, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Apply ``job`` (pages -> rows) to every micro-batch and write its rows below ``out``.

    Each batch owns the folder ``batch=<id>`` and overwrites it, so a batch replayed after a failure
    leaves the same rows.  Runs until the files present now are done.  A folder without rows is written first, so
    that ``out`` can be read, with the job's columns, when the source holds no file.
    """
    job(pages.sparkSession.createDataFrame([], pages.schema)).write.mode("overwrite").parquet(f"{out}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
