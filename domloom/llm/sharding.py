"""Contiguous shards of nearly equal bytes, from global prefix sums.

Only (id, size, checksum, digest) rows move; the texts stay where they are read.  Rows are range
partitioned once, every partition's total is summed, the totals' prefix sums (one row per partition)
give each partition its offset, and a running sum inside the partition gives every row its place in
the global byte line.  The line is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domloom.llm.common import cut, text_bytes


def byte_shards(docs: DataFrame, shards: int, overhead: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, law, shard, slot, grown_shard.

    A row lies in the shard that holds the middle of its bytes, so every shard's size is within one
    row of the target.  The global order is (checksum, MD5, id): equal texts are neighbours and are
    parted only where a cut falls among them; a group of any size spreads over as many partitions as
    it needs, since the id is part of the range key.

    Null text: no bytes, the overhead only.  Null ids sort first.  Repeated rows are rows of their
    own, each with its own slot.  Empty input: no rows.  Other columns of ``docs`` are ignored.
    """
    content = text_bytes(text_column)
    keys = ["text_crc32", "digest", "doc_id"]
    narrow = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(content).cast("long") + F.lit(overhead).cast("long")).alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.md5(content).alias("digest"),
    )
    placed = cut(narrow.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("bytes_all"),
    )
    within = Window.partitionBy("part").orderBy(*keys)
    line = placed.join(F.broadcast(offsets), "part").select(  # one row per partition
        "doc_id", "size", "text_crc32",
        (F.col("bytes_before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("start"),
        (F.col("rows_before") + F.row_number().over(within) - 1).alias("place"),
        "bytes_all",
    )
    middle = F.col("start") * 2 + F.col("size")
    sharded = cut(line.select(
        "doc_id", "size", "text_crc32", "place",
        F.when(F.col("bytes_all") == 0, F.lit(0)).otherwise(
            F.least(F.lit(shards - 1), F.floor(middle * shards / (F.col("bytes_all") * 2)))
        ).cast("int").alias("shard"),
    ))
    first = sharded.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return sharded.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
