"""A node table that pages are crawled into again and again: versioned buckets and a manifest.

A page lies in bucket ``pmod(hash(page_id), buckets)``.  Each write makes new files for the buckets that it touches, and for
those only, under a name of its own; last of all comes the manifest, one row for each bucket with the name that counts.
Readers take the newest manifest, so they see a write as a whole or not at all, and older versions stay readable.  A write
that breaks off leaves files that no manifest names.  One writer at a time: of two that end with the same version the
later one fails and changes nothing.

    store/data/write=3-5f0a/bucket=17/...     nodes with their index columns, by page and document order
    store/stamps/write=3-5f0a/bucket=17/...   (page_id, stamp) of the pages in the bucket
    store/manifest/version=3/...              (bucket, current)
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from domloom.operators.index import with_index
from domloom.schema import INDEX_COLUMNS, NODE_COLUMNS
from domloom.sources.shred import shred
from domloom.sources.store import buckets_for

_STAMPS = "page_id long, stamp long, write string, bucket int"
_PLACE = T.StructType([T.StructField("write", T.StringType()), T.StructField("bucket", T.IntegerType())])


@dataclass
class PageStore:
    """A store under ``path`` (a folder that all executors reach).  ``buckets`` is fixed for its life, and a task holds one:
    take what ``buckets_for`` gives for all pages to come."""

    spark: SparkSession
    path: str
    buckets: int

    def _bucket(self):
        return F.pmod(F.hash("page_id"), F.lit(self.buckets)).cast("int")

    def _files(self, folder: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int | None:
        """The newest version, None before the first write."""
        path, files = self._files("manifest")
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        done = [n for n in names if files.exists(path.suffix(f"/{n}/_SUCCESS"))]
        return max((int(n.removeprefix("version=")) for n in done), default=None)

    def _manifest(self, version: int | None) -> DataFrame:
        if version is None:
            raise ValueError("nothing is stored yet")
        return self.spark.read.schema("bucket int, current string").parquet(f"{self.path}/manifest/version={version}")

    def _current(self, kind: str, schema, version: int | None) -> DataFrame:
        """Rows of the buckets' current files; the manifest's one row a bucket is broadcast and prunes the folders."""
        manifest = self._manifest(version)
        path, files = self._files(kind)  # none if all that was written so far is empty
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{kind}") if files.exists(path) else self.spark.createDataFrame([], schema)
        return rows.join(F.broadcast(manifest.withColumnRenamed("current", "write")), ["write", "bucket"])

    def _node_schema(self) -> T.StructType:
        return T.StructType([*with_index(shred(self.spark.createDataFrame([], "page_id long, html string"))).schema, *_PLACE])

    def nodes(self, version: int | None = None) -> DataFrame:
        """The node table with its index columns, as of ``version`` (default: the newest)."""
        rows = self._current("data", self._node_schema(), self.version() if version is None else version)
        return rows.select(*NODE_COLUMNS, *INDEX_COLUMNS)

    def stamps(self, version: int | None = None) -> DataFrame:
        """``(page_id, stamp)`` of every page that was ever stored, removed ones too."""
        return self._current("stamps", _STAMPS, self.version() if version is None else version).select("page_id", "stamp")

    def upsert(self, pages: DataFrame, stamp: str = "stamp") -> int:
        """Take in ``pages`` (page_id, html, and a number that grows with the time of the crawl); returns the version made.

        Of several rows of a page the latest counts (of equal stamps the html of the least hash), and only if it is later
        than what is stored.  A NULL html removes the page.  Rows without id or stamp are left out.
        """
        version = self.version()
        new = 0 if version is None else version + 1
        latest = Window.partitionBy("page_id").orderBy(F.desc("stamp"), F.xxhash64("html"))
        given = pages.select(F.col("page_id").cast("long").alias("page_id"), "html", F.col(stamp).cast("long").alias("stamp")).where("page_id IS NOT NULL AND stamp IS NOT NULL")
        parts = buckets_for(given)  # the crawl's own tasks; those of the buckets it touches are as large as the buckets
        given = given.repartition(parts, "page_id").withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")
        if version is not None:
            held = self.stamps(version).withColumnRenamed("stamp", "held")
            given = given.join(held, "page_id", "left").where("held IS NULL OR stamp > held").drop("held")
        write = f"{new}-{uuid.uuid4().hex[:8]}"
        given.withColumn("bucket", self._bucket()).write.parquet(f"{self.path}/incoming/write={write}")
        taken = self.spark.read.parquet(f"{self.path}/incoming/write={write}")
        touched = F.broadcast(taken.select("bucket").distinct())  # at most one row a bucket
        ids = taken.select("page_id")
        nodes, stamps = shred(taken.repartition(parts)), taken.select("page_id", "stamp")
        if version is not None:
            kept = self._current("data", self._node_schema(), version).join(touched, "bucket", "left_semi")
            nodes = nodes.unionByName(kept.join(ids, "page_id", "left_anti").select(*NODE_COLUMNS))
            held = self._current("stamps", _STAMPS, version).join(touched, "bucket", "left_semi")
            stamps = stamps.unionByName(held.join(ids, "page_id", "left_anti").select("page_id", "stamp"))
        # Spark's own hash partitioning of page_id into that many parts: a task holds one bucket, and index windows stay in it.
        rows = with_index(nodes.repartition(self.buckets, "page_id"), partitioned=True)
        for kind, df in (("data", rows), ("stamps", stamps.repartition(self.buckets, "page_id"))):
            placed = df.withColumn("bucket", self._bucket()).sortWithinPartitions(*["bucket", "page_id", "pre"][: 3 if kind == "data" else 2])
            placed.write.partitionBy("bucket").parquet(f"{self.path}/{kind}/write={write}")
        manifest = touched.select("bucket", F.lit(write).alias("current"))
        if version is not None:
            manifest = manifest.unionByName(self._manifest(version).join(touched, "bucket", "left_anti"))
        manifest.coalesce(1).write.parquet(f"{self.path}/manifest/version={new}")
        return new
