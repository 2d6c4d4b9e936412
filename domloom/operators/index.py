"""Sibling positions of every node, by windows over the node table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from domloom.operators.segments import index_steps, tasks_for
from domloom.schema import INDEX_COLUMNS, NODE_COLUMNS

# Nodes that make their parent non-empty: elements, and text with at least one character.
_CONTENT = "kind = 1 or (kind = 3 and data <> '')"
# Fixed names of the elements whose text is printed as it is.  They hold text only, so such an element
# is the nearest element before its text.
_VERBATIM = "'style', 'script', 'xmp', 'iframe', 'noembed', 'noframes', 'plaintext'"

_BEFORE = "rows between unbounded preceding and 1 preceding"
_UPTO = "rows between unbounded preceding and current row"
_TYPED = "partition by page_id, parent, tag"
_FAMILY = "partition by page_id, parent"
_PAGE = "partition by page_id order by pre"

# One step per window partitioning, the finest first.
_STEPS = [
    [
        f"row_number() over ({_TYPED} order by pre) as _ty",
        f"count(1) over ({_TYPED}) as _ty_n",
    ],
    [
        f"row_number() over ({_FAMILY} order by pre) as _sib",
        f"count(1) over ({_FAMILY}) as sib_n",
        f"count(if(kind = 1, 1, null)) over ({_FAMILY} order by pre {_UPTO}) as _el",
        f"count(if(kind = 1, 1, null)) over ({_FAMILY}) as _el_n",
        f"last(if(kind = 1, pre, null), true) over ({_FAMILY} order by pre {_BEFORE}) as prev_el",
    ],
    [
        f"lead(if({_CONTENT}, pre, null), 1) ignore nulls over ({_PAGE}) as _next",
        f"last(if(kind = 1, struct(pre, tag), null), true) over ({_PAGE} {_BEFORE}) as _near",
    ],
]
_COLUMNS = {
    "id": "get(filter(attrs, a -> a.name = 'id'), 0).value",
    "class": "get(filter(attrs, a -> a.name = 'class'), 0).value",
    "sib_idx": "cast(_sib as bigint)",
    "sib_n": "sib_n",
    "el_idx": "if(kind = 1, _el, null)",
    "el_rev": "if(kind = 1, _el_n - _el + 1, null)",
    "ty_idx": "if(kind = 1, cast(_ty as bigint), null)",
    "ty_rev": "if(kind = 1, _ty_n - _ty + 1, null)",
    "prev_el": "prev_el",
    "hollow": "kind = 1 and coalesce(_next > last, true)",
    "verbatim": f"kind = 3 and coalesce(_near.pre = parent and _near.tag in ({_VERBATIM}), false)",
}


def without_index(nodes: DataFrame) -> DataFrame:
    """Only the stored columns; every edit ends with this, because positions change."""
    return nodes.select(*NODE_COLUMNS)


def has_index(nodes: DataFrame) -> bool:
    return set(INDEX_COLUMNS) <= set(nodes.columns)


def with_index(nodes: DataFrame, partitioned: bool = False, segment: int | None = None, tasks: int | None = None) -> DataFrame:
    """Add the index columns, all computed inside one ``page_id`` partitioning.

    ``id``, ``class``: plain columns, so that filters on them reach the Parquet scan;
    ``sib_idx/sib_n``: position among all siblings, and their number; ``el_idx/el_rev``: position
    among element siblings from the front and the back; ``ty_idx/ty_rev``: the same among siblings of
    one tag; ``prev_el``: label of the previous element sibling; ``hollow``: no element or text inside;
    ``verbatim``: text printed without escapes.
    The windows a query does not read are pruned by Catalyst, so this is free to apply early.

    The page-wide step comes first, because its exchange serves the finer ones.  With
    ``partitioned`` (rows already partitioned by page) it comes last and leaves each page in document
    order, so that storing the rows needs no further sort.  ``segment``: by segmented scans (see operators.segments), in
    ``tasks`` tasks each, by default ``tasks_for(nodes)``.
    """
    if has_index(nodes):
        return nodes
    rows = nodes.select(*NODE_COLUMNS)
    if segment is not None:
        rows = index_steps(rows, segment, tasks or tasks_for(rows), _CONTENT)
    else:
        for step in _STEPS if partitioned else _STEPS[::-1]:
            rows = rows.selectExpr("*", *step)
    return rows.selectExpr(*NODE_COLUMNS, *[f"{_COLUMNS[c]} as {c}" for c in INDEX_COLUMNS])
