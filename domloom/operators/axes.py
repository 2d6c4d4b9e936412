"""Tree navigation from a set of context nodes.

Every function returns the reached node rows with ``ctx_pre``, the context they were reached from.
``contexts`` are node rows (any selection of the node table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.functions.props import is_element, is_empty_text_node, is_text
from domloom.operators.contain import contained, containing
from domloom.operators.index import with_index


def _hop(contexts: DataFrame, nodes: DataFrame, *links) -> DataFrame:
    """Equi join on ``page_id`` and every (context expression, node column) link."""
    ctx = contexts.select(
        F.col("page_id").alias("_page"), F.col("pre").alias("ctx_pre"), *[c.alias(f"_k{i}") for i, (c, _) in enumerate(links)]
    )
    on = F.col("_page") == F.col("page_id")
    for i, (_, target) in enumerate(links):
        on = on & (F.col(f"_k{i}") == F.col(target))
    return ctx.join(nodes, on).select(*nodes.columns, "ctx_pre")


def parent(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    return _hop(contexts, nodes, (F.col("parent"), "pre"))


def children(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    return _hop(contexts, nodes, (F.col("pre"), "parent"))


def first_child(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    return _hop(contexts, with_index(nodes).filter("sib_idx = 1"), (F.col("pre"), "parent"))


def last_child(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    return _hop(contexts, with_index(nodes).filter("sib_idx = sib_n"), (F.col("pre"), "parent"))


def next_sibling(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The next sibling of any kind.  ``contexts`` must carry the index columns."""
    return _hop(contexts, with_index(nodes), (F.col("parent"), "parent"), (F.col("sib_idx") + 1, "sib_idx"))


def prev_sibling(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The previous sibling of any kind.  ``contexts`` must carry the index columns."""
    return _hop(contexts, with_index(nodes), (F.col("parent"), "parent"), (F.col("sib_idx") - 1, "sib_idx"))


def iter_children(contexts: DataFrame, nodes: DataFrame, include_text: bool = False, skip_empty: bool = False) -> DataFrame:
    """Element children, with text children if asked, without blank text if asked; never comments."""
    keep = is_element()
    if include_text:
        keep = keep | (is_text() & ~is_empty_text_node() if skip_empty else is_text())
    return children(contexts, nodes.filter(keep))


def descendants(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    return contained(contexts, nodes, include_self=False, name="ctx")


def traverse(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The context itself and its descendants."""
    return contained(contexts, nodes, include_self=True, name="ctx")


def ancestors(contexts: DataFrame, nodes: DataFrame, include_self: bool = True) -> DataFrame:
    """The context itself (by default), its ancestors, and the document; nearest first by ``depth`` descending."""
    return containing(contexts, nodes, include_self=include_self, name="ctx")
