"""SQL face: a table function over page text and views over the node table."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from domloom.operators.index import with_index
from domloom.schema import NODES
from domloom.sources.pagetree import PageTree

_ROW = T.StructType([f for f in NODES.fields if f.name != "page_id"])


class _HtmlNodes:
    def eval(self, html):
        if html is None:
            return
        if isinstance(html, (bytes, bytearray)):
            html = bytes(html).decode("utf-8", "replace")
        columns = defaultdict(list)
        PageTree(html).emit(None, columns)
        yield from zip(*(columns[n] for n in _ROW.fieldNames()))


def register(spark: SparkSession, name: str = "html_nodes") -> None:
    """``SELECT ... FROM pages p, LATERAL html_nodes(p.html) n``."""
    spark.udtf.register(name, udtf(_HtmlNodes, returnType=_ROW))


def create_view(nodes: DataFrame, name: str = "nodes") -> None:
    """A temporary view with the index columns; windows a query does not read are pruned."""
    with_index(nodes).createOrReplaceTempView(name)
