"""Edits: node table -> new node table.

Targets are selectors or a DataFrame of nodes (see operators.targets).
``last`` is not shrunk by removals: it stays a valid upper bound of the subtree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.operators.contain import contained_pairs
from domloom.operators.index import without_index
from domloom.operators.segments import scan, tasks_for
from domloom.operators.targets import flagged
from domloom.plans.match import match
from domloom.plans.selector import compile_selector
from domloom.schema import DOCUMENT, ELEMENT, NODE_COLUMNS

# Fixed names of the elements whose children make up the two search scopes.
_IS_BODY = "tag = 'body' and depth = 2"
_IS_HEAD = "tag = 'head' and depth = 2"


def _guard(condition: Column, error: str, value: Column) -> Column:
    """``value``, but the job fails with ``error`` on a row where ``condition`` holds."""
    return F.when(condition, F.raise_error(F.lit(error)).cast("boolean")).otherwise(value)


def decompose(nodes: DataFrame, targets, scope: str = "body", include_root: bool = False, segment: int | None = None) -> DataFrame:
    """Drop the targets with their subtrees.  Removing the document node fails with ``RootNode``.

    Subtrees nest, so a running maximum of the targets' ``last`` tells every covered row: no join.  With ``segment`` that
    is a segmented scan, and no page has to fit a task (see operators.segments).
    """
    plain = scope == "body" and not include_root and not isinstance(targets, DataFrame)
    if segment is not None:
        tasks = tasks_for(nodes)
        if not isinstance(targets, DataFrame):
            joined = ", ".join(targets) if isinstance(targets, (list, tuple)) else targets
            targets = match(nodes, compile_selector(joined) if isinstance(joined, str) else joined, scope, include_root, segment)
        nodes, targets = (rows.repartition(tasks, "page_id", "pre") for rows in (nodes, targets))
    rows = flagged(nodes, targets, scope, include_root)
    rows = rows.withColumn("_hit", _guard(F.col("_hit") & (F.col("kind") == DOCUMENT), "RootNode", F.col("_hit")))
    page = {"page": "coalesce(page_id, -1L)"}
    if segment is not None:
        rows = scan(rows, page, segment, tasks, _reach=("max_upto", "if(_hit, last, null)"))
    else:
        upto = "partition by page_id order by pre rows between unbounded preceding and current row"
        rows = rows.selectExpr("*", f"max(if(_hit, last, null)) over ({upto}) as _reach")
    rows = rows.filter("_reach is null or _reach < pre")
    if plain:
        return without_index(rows)
    # The body itself may be gone; the root element is then what searches start from.
    has_body = f"max({_IS_BODY}) over (partition by page_id)"
    if segment is not None:
        rows, has_body = scan(rows, page, segment, tasks, _bodies=("count_all", f"if({_IS_BODY}, 1, null)")), "_bodies > 0"
    return without_index(rows.withColumn("in_body", F.expr(f"if({has_body}, in_body, depth >= 2)")))


remove = decompose


def decompose_shallow(nodes: DataFrame, targets, scope: str = "body", include_root: bool = False) -> DataFrame:
    """Detach the targets.  Their children go with them; :func:`unwrap` is the edit that keeps the children."""
    return decompose(nodes, targets, scope, include_root)


def strip_tags(nodes: DataFrame, selectors: list, scope: str = "body") -> DataFrame:
    """Drop everything any of the selectors matches, in one pass."""
    return decompose(nodes, list(selectors), scope)


def unwrap(nodes: DataFrame, targets, scope: str = "body") -> DataFrame:
    """Drop the targets; their children take their place."""
    columns = NODE_COLUMNS
    rows = flagged(nodes, targets, scope)
    # Targets still open before each node = +1 where one opens, -1 after its last label.
    rows = rows.selectExpr(
        *columns,
        "_hit",
        """inline(array_compact(array(
            struct(pre as pos, 0 as phase, if(_hit, 1, 0) as edge),
            if(_hit, struct(last as pos, 1 as phase, -1 as edge), null))))""",
    )
    before = "partition by page_id order by pos, phase rows between unbounded preceding and 1 preceding"
    rows = rows.selectExpr("*", f"coalesce(sum(edge) over ({before}), 0L) as _open").filter("phase = 0 and not _hit")
    rows = rows.withColumn("depth", F.expr("cast(depth - _open as int)"))
    # The new parent is the latest kept node one level up.  Each row stands once as a possible
    # parent (side 1, its own level) and once as a child (side 0, the level above).
    sides = "inline(array(struct(depth - 1 as _level, 0 as _side), struct(depth as _level, 1 as _side)))"
    rows = rows.selectExpr(*columns, sides)
    level = "partition by page_id, _level order by pre, _side rows between unbounded preceding and 1 preceding"
    up = f"last(if(_side = 1, pre, null), true) over ({level})"
    return rows.withColumn("parent", F.expr(up)).filter("_side = 0").select(*columns)


def append_text(nodes: DataFrame, targets, text: str | Column, scope: str = "body", include_root: bool = False) -> DataFrame:
    """Add a text node as the last child of each target element; other kinds are left alone.

    New labels fit right after the target's last one: the page's labels are spread by the largest
    number of texts that land on one spot (targets ending together), so no row is renumbered by rank
    and everything is local to ``(page_id, last)``.
    """
    rows = flagged(nodes, targets, scope, include_root)
    rows = rows.withColumn("_text", F.lit(text) if isinstance(text, str) else text)
    rows = rows.selectExpr(*NODE_COLUMNS, "_text", "_hit and kind = 1 as _hit")
    spot = "partition by page_id, last"
    deeper = f"{spot} order by depth desc rows between unbounded preceding and current row"
    rows = rows.selectExpr(
        "*", f"count(if(_hit, 1, null)) over ({deeper}) as _n", f"count(if(_hit, 1, null)) over ({spot}) as _here"
    )
    rows = rows.selectExpr("*", "max(_here) over (partition by page_id) + 1 as _step")
    kept = {c: c for c in NODE_COLUMNS} | {"pre": "pre * _step", "last": "last * _step + _n", "parent": "parent * _step"}
    added = kept | {
        "node_id": "cast(null as bigint)",
        "pre": kept["last"],
        "parent": kept["pre"],
        "depth": "depth + 1",
        "kind": "3",
        "ns": "''",
        "tag": "''",
        "attrs": "filter(attrs, a -> false)",
        "data": "_text",
        "in_head": f"in_head or {_IS_HEAD}",
        "in_body": f"in_body or {_IS_BODY}",
    }
    old, new = (f"struct({', '.join(f'{e} as {c}' for c, e in row.items())})" for row in (kept, added))
    return rows.selectExpr(f"inline(array_compact(array({old}, if(_hit, {new}, null))))")


def _edit_attrs(nodes, targets, scope, include_root, on_error, error, edit) -> DataFrame:
    rows = flagged(nodes, targets, scope, include_root)
    wrong = F.col("_hit") & (F.col("kind") != ELEMENT)
    if on_error == "raise":
        rows = rows.withColumn("_hit", _guard(wrong, error, F.col("_hit")))
    attrs = F.when(F.col("_hit") & (F.col("kind") == ELEMENT), edit(F.col("attrs"))).otherwise(F.col("attrs"))
    return without_index(rows.withColumn("attrs", attrs))


def set_attr(nodes: DataFrame, targets, name: str, value: str | None, scope: str = "body", include_root: bool = False,
             on_error: str = "raise") -> DataFrame:
    """Set or replace an attribute; ``None`` makes it empty.

    A target that is not an element fails the job; with ``on_error='skip'`` it is left as it is
    (:func:`not_elements` lists such targets).
    """
    if "\0" in name:
        raise ValueError(f"invalid attribute name: {name!r}")
    name = name.lower()
    new = F.struct(F.lit(name).alias("name"), F.lit(value or "").alias("value"))

    def edit(attrs):
        replaced = F.transform(attrs, lambda a: F.when(a["name"] == name, new).otherwise(a))
        return F.when(F.exists(attrs, lambda a: a["name"] == name), replaced).otherwise(F.concat(attrs, F.array(new)))

    return _edit_attrs(nodes, targets, scope, include_root, on_error, "SetAttribute: not an element node", edit)


def remove_attr(nodes: DataFrame, targets, name: str, scope: str = "body", include_root: bool = False,
                on_error: str = "raise") -> DataFrame:
    """Remove an attribute; no effect where it is absent."""
    if "\0" in name:
        raise ValueError(f"invalid attribute name: {name!r}")
    name = name.lower()
    return _edit_attrs(nodes, targets, scope, include_root, on_error, "RemoveAttribute: not an element node",
                       lambda attrs: F.filter(attrs, lambda a: a["name"] != name))


def not_elements(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets an attribute edit cannot apply to: ``(page_id, pre, error)``."""
    hits = nodes.filter(F.col("kind") != ELEMENT).join(targets.select("page_id", "pre"), ["page_id", "pre"], "left_semi")
    return hits.select("page_id", "pre", F.lit("not an element node").alias("error"))


def clone_subtree(contexts: DataFrame, nodes: DataFrame) -> DataFrame:
    """Detached copies: the subtree of each context with labels counted from its root.

    ``clone_of`` is the label of the copied root; ``(page_id, clone_of)`` names the new tree.
    """
    rows = contained_pairs(contexts, nodes.select(*NODE_COLUMNS), True, "depth as _root_depth")
    at = F.col("_lo")
    moved = {
        "pre": F.col("pre") - at,
        "last": F.col("last") - at,
        "parent": F.when(F.col("pre") != at, F.col("parent") - at),
        "depth": F.col("depth") - F.col("_root_depth"),
        "in_head": F.lit(False),
        "in_body": F.lit(False),
    }
    return rows.select(at.alias("clone_of"), *[moved.get(c, F.col(c)).alias(c) for c in NODE_COLUMNS])


def clone_shallow(contexts: DataFrame) -> DataFrame:
    """Detached copies of the context nodes alone, attributes kept."""
    zero = F.lit(0).cast("long")
    moved = {
        "pre": zero,
        "last": zero,
        "parent": F.lit(None).cast("long"),
        "depth": F.lit(0),
        "in_head": F.lit(False),
        "in_body": F.lit(False),
    }
    return contexts.select(F.col("pre").alias("clone_of"), *[moved.get(c, F.col(c)).alias(c) for c in NODE_COLUMNS])


def removed_nodes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` that an edit removed (matched on the stable ``node_id``)."""
    return before.join(after.select("page_id", "node_id"), ["page_id", "node_id"], "left_anti")


def is_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """``before`` with boolean ``is_removed``."""
    kept = after.filter("node_id is not null").select("page_id", "node_id", F.lit(False).alias("is_removed"))
    return before.join(kept, ["page_id", "node_id"], "left").withColumn("is_removed", F.coalesce("is_removed", F.lit(True)))
