"""Text and HTML of context nodes as slices of their page's text.

What the nodes print, in document order, is one string a page; everything below a context is a stretch of it.  A running
sum of the pieces' bytes along the page gives every piece its offset, and every context the two offsets between which it
lies, wherever contexts nest.  So a piece is sorted and joined once, not once for each context around it, there is no
interval join, and all work is one window and one aggregation inside ``page_id``.  Offsets count bytes, because taking a
stretch of a binary value does not read what stands before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.operators.index import with_index
from domloom.operators.select import compiled, select
from domloom.plans.match import scope_filter
from domloom.plans.selector import any_of

# Where something stands on the page: at a label; opening before closing; of nodes that end together the deeper closes
# first; marks before (-1) or after (1) the piece of their own place.
_PLACE = "pos, phase, tie, sub"
OPENING, CLOSING = "pre as pos, 0 as phase, 0 as tie", "last as pos, 1 as phase, -depth as tie"
_NO_MARK = "cast(null as bigint) as ctx, cast(null as string) as key, cast(null as string) as note"


def contexts_of(contexts, nodes: DataFrame, scope: str, include_root: bool) -> DataFrame:
    """Context rows, each node once.  ``contexts`` is a selector or a DataFrame of nodes."""
    if isinstance(contexts, DataFrame):
        return contexts.dropDuplicates(["page_id", "pre"])
    return select(nodes, contexts, scope, include_root, on_error="raise")


def piece(place: str, value: str) -> str:
    """SQL for a piece of the page's text; ``value`` may be NULL."""
    return f"struct({place}, 0 as sub, {value} as piece, {_NO_MARK})"


def marks(inner: bool = False, note: str = "cast(null as string)", key: str = "cast(null as string)") -> list[str]:
    """SQL for the two ends of a context: around its own opening and closing pieces, or between them."""
    way = 1 if inner else -1
    own = f"cast(null as string) as piece, pre as ctx, {key} as key, {note} as note"
    return [f"struct({OPENING}, {way} as sub, {own})", f"struct({CLOSING}, {-way} as sub, {own})"]


def _rows(df: DataFrame, structs: list[str]) -> DataFrame:
    return df.selectExpr("page_id", f"inline(array_compact(array({', '.join(structs)})))")


def pieces_and_marks(contexts, nodes: DataFrame, pieces: list[str], ends: list[str], scope: str, include_root: bool, used: Column | None = None) -> DataFrame:
    """The pieces of all nodes (of those that ``used`` holds for) and the ends of the contexts.

    Contexts that a selector without combinators describes are told by their own row, in the same scan; others are
    looked up by ``(page_id, pre)``, which a table bucketed by page answers without a shuffle.  Where few nodes have pieces,
    contexts given as a table come beside those instead, so that no other rows are read; that does shuffle the pieces.
    """
    rows = with_index(nodes)
    if isinstance(contexts, DataFrame) and used is not None:
        return _rows(rows.filter(used), pieces).unionByName(_rows(contexts_of(contexts, nodes, scope, include_root), ends))
    used = F.lit(True) if used is None else used
    if not isinstance(contexts, DataFrame) and (selector := compiled(contexts)).is_flat:
        hit = selector.column() & scope_filter(scope, include_root)
    else:
        marked = contexts_of(contexts, nodes, scope, include_root).select("page_id", "pre", F.lit(True).alias("_mark"))
        rows, hit = rows.filter(used | _may_be(contexts)).join(marked, ["page_id", "pre"], "left"), F.col("_mark").isNotNull()
    rows = rows.filter(used | hit).withColumns({"_used": used, "_hit": F.coalesce(hit, F.lit(False))})
    return _rows(rows, [f"if(_used, {p}, null)" for p in pieces] + [f"if(_hit, {e}, null)" for e in ends])


def _may_be(contexts) -> Column:
    """A condition on one node row that holds for every context; the fewer other rows are read, the better."""
    if isinstance(contexts, DataFrame):
        return F.lit(True)
    last = [p.steps[-1] for p in compiled(contexts).parts]
    return any_of(step.column() for step in last) if all(step.alone() for step in last) else F.col("kind") == 1


def pages_of(rows: DataFrame, *more: Column) -> DataFrame:
    """A row for each page with marks: ``page_id``, ``whole`` (bytes of all pieces), ``marks`` by context and key, and ``more``.

    A context's two marks stand next to each other, its start first.
    """
    before = f"partition by page_id order by {_PLACE} rows between unbounded preceding and 1 preceding"
    placed = rows.selectExpr("*", f"coalesce(sum(octet_length(piece)) over ({before}), 0L) as _off")
    return placed.groupBy("page_id").agg(
        F.expr("cast(array_join(transform(sort_array(collect_list(if(octet_length(piece) > 0, struct(_off, piece), null))), p -> p.piece), '') as binary) as whole"),
        F.expr("sort_array(collect_list(if(ctx is not null, struct(key, ctx, _off, note), null))) as marks"),
        *more,
    )


#: SQL for mark ``i``'s context as text, over the columns of :func:`pages_of`.
SLICE = "cast(substring(whole, cast(marks[2 * {i}]._off as int) + 1, cast(marks[2 * {i} + 1]._off - marks[2 * {i}]._off as int)) as string)"
PAIRS = "if(size(marks) > 0, sequence(0, size(marks) div 2 - 1), array())"


def slices(contexts, nodes: DataFrame, pieces: list[str], ends: list[str], scope: str, include_root: bool, used: Column | None = None) -> DataFrame:
    """``(page_id, pre, joined, note)`` for every context: its pieces in order, and what ``note`` says of it."""
    pages = pages_of(pieces_and_marks(contexts, nodes, pieces, ends, scope, include_root, used))
    each = pages.selectExpr("page_id", "whole", f"explode(transform({PAIRS}, i -> struct(marks[2 * i] as a, marks[2 * i + 1]._off as stop))) as c")
    stretch = "cast(substring(whole, cast(c.a._off as int) + 1, cast(c.stop - c.a._off as int)) as string)"
    return each.selectExpr("page_id", "c.a.ctx as pre", f"{stretch} as joined", "c.a.note as note")

