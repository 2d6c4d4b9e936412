"""Indexed node lists, one per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domloom.operators.select import match_counts


def collection(matches: DataFrame) -> DataFrame:
    """``matches`` with ``idx`` from 0 in document order within each page."""
    order = Window.partitionBy("page_id").orderBy("pre")
    return matches.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))


def empty_collection(nodes: DataFrame) -> DataFrame:
    return collection(nodes.limit(0))


def length(pages: DataFrame, items: DataFrame) -> DataFrame:
    """``(page_id, len, is_empty)`` for every page."""
    return match_counts(pages, items).select("page_id", F.col("n").alias("len"), (F.col("n") == 0).alias("is_empty"))


def get(items: DataFrame, index: int) -> DataFrame:
    """The ``index``-th node of each page's list; pages with fewer nodes give no row."""
    return items.filter(F.col("idx") == index)
