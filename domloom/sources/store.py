"""Reading page tables; writing the node table once and reading it many times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domloom.operators.index import with_index
from domloom.session import shared_dir
from domloom.sources.shred import shred

#: HTML that one task turns into nodes, sorts and writes.  Its node rows take 10 to 20 times that, as they are sorted several times.
BUCKET_BYTES = 16 * 2**20


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A pages parquet folder or file, only the columns the library uses.

    ``partitions`` deals the raw rows out anew, for files of few, large row groups; by default a task
    reads one split (``spark.sql.files.maxPartitionBytes``) and nothing is moved.
    """
    pages = spark.read.parquet(path).select("page_id", "url", "html")
    return pages if partitions is None else pages.repartition(partitions)


def duplicates(pages: DataFrame) -> DataFrame:
    """``(page_id, n)`` of the ids that stand in several rows: such pages would share one tree."""
    counts = pages.filter("page_id is not null").groupBy("page_id").count()
    return counts.filter("count > 1").withColumnRenamed("count", "n")


def buckets_for(pages: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for the node table of ``pages``, so that a task's share does not grow with the table: one for each
    ``bucket_bytes`` of HTML, one a core at least.  Reads ``html`` once, to add up its bytes."""
    total = pages.agg(F.sum(F.octet_length("html"))).head()[0] or 0
    return max(pages.sparkSession.sparkContext.defaultParallelism, -(-total // bucket_bytes))


def write_nodes(nodes: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write a node table bucketed by page and return it as read back.

    One shuffle on ``page_id`` feeds both the sibling-position windows and the bucketed files, and
    later page-wise windows, aggregations and joins on the table need no shuffle at all, as long as
    the session that reads has the settings of ``domloom.session.tune``.  A task holds one bucket, so ``buckets`` has to
    grow with the pages, as ``buckets_for`` does; what does not fit a task's memory is sorted on disk.
    """
    spark = nodes.sparkSession
    (
        with_index(nodes.repartition(buckets, "page_id"), partitioned=True)
        .write.format("parquet")
        .option("path", path)
        .bucketBy(buckets, "page_id")
        .sortBy("page_id", "pre")
        .mode("errorifexists")
        .saveAsTable(table)
    )
    return spark.table(table)


def materialize(pages: DataFrame, buckets: int | None = None) -> DataFrame:
    """Shred ``pages`` into a written node table in the session's shared folder.

    By default there are ``buckets_for(pages)`` buckets, and the pages are dealt out to as many tasks before they are shredded.
    """
    spark = pages.sparkSession
    if buckets is None:
        buckets = buckets_for(pages)
        pages = pages.repartition(buckets)
    name = f"domloom_nodes_{uuid.uuid4().hex}"
    return write_nodes(shred(pages), name, f"{shared_dir(spark)}/nodes", buckets)
