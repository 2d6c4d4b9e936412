"""HTML of context nodes.

``contexts`` is a selector or a DataFrame of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.operators.assemble import CLOSING, OPENING, marks, piece, slices

# Fixed values of the HTML standard's serialization rules.
NO_CLOSE = "area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split()

_BLANK = r"not coalesce(data, '') rlike '[^ \\t\\n\\f\\r]'"
# Each pretty line starts with a NUL (never in page text) and two blanks per level of the page; the
# context's own level is taken off its slice afterwards.
_PAD = "'\\u0000', repeat('  ', depth), "


def _in(column: str, values: list) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def _escaped(value: str, attr: bool = False) -> str:
    value = f"replace(replace({value}, '&', '&amp;'), '\\u00a0', '&nbsp;')"
    if attr:
        return f"replace({value}, '\"', '&quot;')"
    return f"replace(replace({value}, '<', '&lt;'), '>', '&gt;')"


def _prints(raw=False, without_closing=False, tag_with_ns=False, full_doctype=False, skip_ws_nodes=False, skip_comment=False):
    """SQL for what a node prints where it opens and where it closes."""
    tag = "concat(ns, ':', tag)" if tag_with_ns else "tag"
    # An attribute written without a value is printed without one.
    value = "a.value" if raw else _escaped("a.value", attr=True)
    attrs = f"array_join(transform(attrs, a -> concat(' ', a.name, coalesce(concat('=\"', {value}, '\"'), ''))), '')"
    data = "data" if raw else f"if(verbatim, data, {_escaped('data')})"
    doctype = "data" if full_doctype else "substring_index(data, ' ', 1)"
    opening = f"""case
        when kind = 1 then concat('<', {tag}, {attrs}, '>')
        when kind = 3 {f"and not ({_BLANK})" if skip_ws_nodes else ""} then {data}
        when kind = 8 {"and false" if skip_comment else ""} then concat('<!--', data, '-->')
        when kind = 10 then concat('<!DOCTYPE ', {doctype}, '>') end"""
    closes = "false" if without_closing else f"kind = 1 and not {_in('tag', NO_CLOSE)}"
    return opening, f"if({closes}, concat('</', {tag}, '>'), null)"


def _html(contexts, nodes: DataFrame, inner: bool, prints, scope: str, include_root: bool) -> DataFrame:
    opening, closing = prints
    pieces = [piece(OPENING, opening), f"if(kind = 1, {piece(CLOSING, closing)}, null)"]
    out = slices(contexts, nodes, pieces, marks(inner, "cast(depth as string)"), scope, include_root)
    return out.withColumnRenamed("joined", "html")


def outer_html(contexts, nodes: DataFrame, scope: str = "body", include_root: bool = False) -> DataFrame:
    """``(page_id, pre, html)``: each context with its subtree."""
    return _html(contexts, nodes, False, _prints(), scope, include_root).drop("note")


def inner_html(contexts, nodes: DataFrame, scope: str = "body", include_root: bool = False) -> DataFrame:
    """``(page_id, pre, html)``: what is inside each context."""
    return _html(contexts, nodes, True, _prints(), scope, include_root).drop("note")


def _pretty(contexts, nodes, inner, indent, without_text_indent, scope, include_root, flags):
    opening, closing = _prints(**flags)
    pad = _PAD if not without_text_indent else "if(kind in (3, 8), '', concat(" + _PAD.rstrip(", ") + ")), "
    lines = f"concat({pad}{opening}, '\\n')", f"concat({_PAD}{closing}, '\\n')"
    out = _html(contexts, nodes, inner, lines, scope, include_root)
    lead = f"concat('\\u0000', repeat('  ', cast(note as int) + {int(inner)}))"
    return out.select("page_id", "pre", F.replace("html", F.expr(lead), F.lit("  " * indent)).alias("html"))


def outer_html_pretty(
    contexts,
    nodes: DataFrame,
    indent: int = 0,
    without_text_indent: bool = False,
    scope: str = "body",
    include_root: bool = False,
    **flags: bool,
) -> DataFrame:
    """Each context with its subtree, one tag, text or comment per line, two blanks per level.

    ``indent``: level of the first line; ``without_text_indent``: text and comments start at the
    margin.  Flags: ``skip_ws_nodes``: no blank text; ``skip_comment``: no comments; ``raw``: no
    escaping; ``without_closing``: no end tags; ``tag_with_ns``: ``html:div``; ``full_doctype``: public
    and system identifiers too.
    """
    return _pretty(contexts, nodes, False, indent, without_text_indent, scope, include_root, flags)


def inner_html_pretty(
    contexts,
    nodes: DataFrame,
    indent: int = 0,
    without_text_indent: bool = False,
    scope: str = "body",
    include_root: bool = False,
    **flags: bool,
) -> DataFrame:
    """As :func:`outer_html_pretty`, children only."""
    return _pretty(contexts, nodes, True, indent, without_text_indent, scope, include_root, flags)
