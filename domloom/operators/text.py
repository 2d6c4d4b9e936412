"""Text of context nodes.

``contexts`` is a selector or a DataFrame of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.functions.props import is_empty_text_node, is_text
from domloom.functions.strings import trim_unicode
from domloom.operators.assemble import OPENING, marks, slices
from domloom.operators.assemble import piece as text_piece
from domloom.operators.index import with_index
from domloom.operators.targets import flagged


def text(contexts, nodes: DataFrame, strip: bool = False, per_fragment: bool = False, separator: str = "",
         skip_empty: bool = False, scope: str = "body", include_root: bool = False) -> DataFrame:
    """``(page_id, pre, text)``: all text below each context, concatenated in document order.

    ``strip`` trims the whole text once; ``separator`` and ``skip_empty`` have no effect unless
    ``per_fragment=True``, which applies all three to every text node before joining.
    A comment context gives its own data.
    """
    used, piece = is_text(), F.col("data")
    if per_fragment:
        if skip_empty:
            used = used & ~is_empty_text_node()
        if strip:
            piece = trim_unicode(piece)
    between = separator if per_fragment else ""
    rows = with_index(nodes).withColumn("_text", F.concat(piece, F.lit(between)) if between else piece)
    ends = marks(note="if(kind = 8, data, null)")
    if isinstance(contexts, DataFrame):
        contexts = contexts.select("page_id", "pre", "last", "depth", "kind", "data")
    out = slices(contexts, rows, [text_piece(OPENING, "_text")], ends, scope, include_root, used)
    if between:  # one stands after the last piece too
        out = out.withColumn("joined", F.expr(f"if(joined = '', '', substring(joined, 1, length(joined) - {len(between)}))"))
    whole = F.coalesce("note", "joined")
    return out.select("page_id", "pre", (trim_unicode(whole) if strip and not per_fragment else whole).alias("text"))


def text_shallow(contexts, nodes: DataFrame, separator: str = "", strip: bool = False, skip_empty: bool = False,
                 scope: str = "body", include_root: bool = False) -> DataFrame:
    """``(page_id, pre, text)``: own text of a text context, then its direct text children, joined.

    ``strip`` trims each part, ``skip_empty`` drops blank parts, ``separator`` goes between parts.
    """
    part = trim_unicode(F.col("data")) if strip else F.col("data")
    if skip_empty:
        part = F.when(~is_empty_text_node() & (part != ""), part)
    rows = flagged(nodes, contexts, scope, include_root).filter("_hit or kind = 3").withColumn("_part", part)
    # A row counts for itself when it is a context, and for its parent when it is text.
    rows = rows.selectExpr(
        "page_id",
        """inline(array_compact(array(
            if(_hit, named_struct('pre', pre, 'ctx', true, 'part', if(kind = 3 and _part is not null, struct(pre as at, _part as part), null)), null),
            if(kind = 3 and data <> '' and _part is not null,
               named_struct('pre', parent, 'ctx', false, 'part', struct(pre as at, _part as part)), null))))""",
    )
    parts = F.transform(F.sort_array(F.collect_list("part")), lambda p: p["part"])
    grouped = rows.groupBy("page_id", "pre").agg(F.max("ctx").alias("ctx"), F.array_join(parts, separator).alias("text"))
    return grouped.filter("ctx").select("page_id", "pre", "text")
