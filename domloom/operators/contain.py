"""The interval join behind subtree, ancestor and scoped queries.

A range join turned into an equi join: document order is cut into blocks of labels, an outer node
is listed once per block its subtree touches, and the join key is ``(page_id, block)``.  A page of
ordinary size is a few blocks; a huge page spreads over many tasks instead of one, and work stays
near the number of result rows instead of outer x inner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 32


def block_of(label: str) -> str:
    return f"{label} div {BLOCK}"


def blocks(first: str, last: str) -> str:
    """One row per block of an interval of labels."""
    return f"explode(sequence({block_of(first)}, {block_of(last)}))"


def _inside(include_self: bool):
    return F.expr(f"page_id = _page and _block = _at_block and _pre {'>=' if include_self else '>'} _lo and _pre <= _hi")


def contained_pairs(outer: DataFrame, inner: DataFrame, include_self: bool, *carry: str) -> DataFrame:
    """``inner`` rows with ``_lo``, the label of an ``outer`` node around them, and the ``carry`` columns of that node."""
    spans = outer.selectExpr("page_id as _page", "pre as _lo", "last as _hi", *carry, f"{blocks('pre', 'last')} as _block")
    points = inner.selectExpr("*", f"{block_of('pre')} as _at_block", "pre as _pre")
    return points.join(spans, _inside(include_self))


def contained(outer: DataFrame, inner: DataFrame, include_self: bool = False, name: str = "outer") -> DataFrame:
    """``inner`` rows inside each ``outer`` node's subtree, with ``<name>_pre`` added."""
    return contained_pairs(outer, inner, include_self).selectExpr(*inner.columns, f"_lo as {name}_pre")


def containing(inner: DataFrame, outer: DataFrame, include_self: bool = True, name: str = "inner") -> DataFrame:
    """``outer`` rows whose subtree holds each ``inner`` node, with ``<name>_pre`` added."""
    spans = outer.selectExpr("*", "pre as _lo", "last as _hi", f"{blocks('pre', 'last')} as _block")
    points = inner.selectExpr("page_id as _page", f"{block_of('pre')} as _at_block", "pre as _pre")
    return spans.join(points, _inside(include_self)).selectExpr(*outer.columns, f"_pre as {name}_pre")
