"""Pages -> node rows, in one narrow stage (no shuffle)."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.schema import NODES
from domloom.sources.pagetree import PageTree

FLUSH_ROWS = 32_768

_FLAT = {
    "page_id": pa.int64(),
    "node_id": pa.int64(),
    "pre": pa.int64(),
    "last": pa.int64(),
    "parent": pa.int64(),
    "depth": pa.int32(),
    "kind": pa.int32(),
    "ns": pa.string(),
    "tag": pa.string(),
    "data": pa.string(),
    "in_head": pa.bool_(),
    "in_body": pa.bool_(),
}


def _attr_column(rows):
    offsets, names, values = [0], [], []
    for attrs in rows:
        for name, value in attrs:
            names.append(name)
            values.append(value)
        offsets.append(len(names))
    pairs = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], ["name", "value"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _batch(columns):
    return pa.RecordBatch.from_arrays(
        [_attr_column(columns["attrs"]) if n == "attrs" else pa.array(columns[n], _FLAT[n]) for n in NODES.fieldNames()],
        names=NODES.fieldNames(),
    )


def _shred(batches):
    columns, rows = defaultdict(list), 0
    for batch in batches:
        for page_id, html in zip(batch.column(0), batch.column(1)):
            html = html.as_py()
            if isinstance(html, bytes):
                html = html.decode("utf-8", "replace")
            rows += PageTree(html).emit(page_id.as_py(), columns)
            if rows >= FLUSH_ROWS:
                full = _batch(columns)
                columns, rows = defaultdict(list), 0
                for start in range(0, full.num_rows, FLUSH_ROWS):
                    yield full.slice(start, FLUSH_ROWS)
    if rows:
        yield _batch(columns)


def shred(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Node rows of every page.  ``html`` may be a string or binary (invalid UTF-8 is replaced) column.

    Pages with a NULL html or page_id yield no rows; see :func:`rejects`.
    """
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).alias("html"))
    return source.dropna().mapInArrow(_shred, NODES)


def rejects(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Pages that cannot be shredded, with the reason."""
    why = F.when(F.col(page_id).isNull(), "page_id is null").when(F.col(html).isNull(), "html is null")
    return pages.select(F.col(page_id).alias("page_id"), why.alias("error")).filter("error is not null")
