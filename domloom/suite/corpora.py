"""The two page corpora the registered queries run on.

``pages`` is the given table of raw pages.  ``documents`` rows are turned into pages by one Spark
projection: ids, several classes, blank text, comments, valueless attributes, empty and nested
elements, none of which the raw pages have.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domloom.functions.strings import escape_text
from domloom.session import tune
from domloom.sources.store import materialize, read_pages

_written: dict[tuple, DataFrame] = {}


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and a folder for written tables where it names none (local runs)."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="domloom-"))
    return tune(spark)


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    number = F.col("n_chars").cast("string")
    doc = F.col("doc_id").cast("string")

    def paragraph(line, i):
        return F.concat(F.lit('<p data-i="'), i.cast("string"), F.lit('">'), escape_text(line), F.lit("</p>\n"))

    html = F.concat(
        F.lit('<!DOCTYPE html PUBLIC "-//W3C//DTD HTML 4.01//EN" "http://www.w3.org/TR/html4/strict.dtd"><div id="doc-'), doc, F.lit('" class="doc '), "lang", F.lit("  "), "source", F.lit('">\n <!--'), "lang", F.lit("-->"),
        F.array_join(F.transform(F.split("text", "\n"), paragraph), ""),
        F.lit('<input disabled value="'), number, F.lit('"><ul class="meta"><li>'), "lang",
        F.lit("<ul><li>"), "source", F.lit("</li></ul></li><li>"), number, F.lit("</li></ul></div>"),
    )
    return docs.select(
        F.col("doc_id").alias("page_id"), F.concat(F.lit("https://docs.example/"), doc).alias("url"), html.alias("html")
    )


def _nodes(spark: SparkSession, sf_dir: str, corpus) -> DataFrame:
    """The corpus's node table, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, corpus.__name__)
    if key not in _written:
        _written[key] = materialize(corpus(session(spark), sf_dir))
    return _written[key]


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir, pages)


def doc_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes(spark, sf_dir, doc_pages)
