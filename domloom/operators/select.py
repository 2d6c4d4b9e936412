"""Selection: the query operators over a node table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domloom.errors import SelectorParseError, UnsupportedSelector
from domloom.operators.contain import contained
from domloom.operators.index import with_index
from domloom.plans.match import match
from domloom.plans.rules import FEW, match_index, rule_index
from domloom.plans.selector import Selector, compile_selector


def compiled(selector: str | Selector) -> Selector:
    """``selector`` itself, or the compiled text."""
    return selector if isinstance(selector, Selector) else compile_selector(selector)


def select(
    nodes: DataFrame,
    selector: str | Selector,
    scope: str = "body",
    include_root: bool = False,
    on_error: str = "empty",
    segment: int | None = None,
) -> DataFrame:
    """Matching node rows of every page, each once.

    ``scope`` is ``body`` (default), ``head`` or ``document``.  A selector that does not parse
    matches nothing; with ``on_error='raise'`` it raises.  Valid CSS that is not supported always raises
    ``UnsupportedSelector``.  ``segment``: for tables with pages that one task cannot hold, deal each page out by so many
    labels (see operators.segments).
    """
    try:
        return match(nodes, compiled(selector), scope, include_root, segment)
    except SelectorParseError:
        if on_error == "raise":
            raise
        return with_index(nodes).limit(0)


def tags(nodes: DataFrame, name: str, scope: str = "body") -> DataFrame:
    """Elements by tag name (any selector works)."""
    return select(nodes, name, scope)


def with_match_idx(matches: DataFrame) -> DataFrame:
    """Number the matches of each page from 1 in document order."""
    order = Window.partitionBy("page_id").orderBy("pre")
    return matches.withColumn("match_idx", F.row_number().over(order).cast("long"))


def first_per_page(matches: DataFrame, k: int = 1) -> DataFrame:
    """The first ``k`` matches of each page; Spark keeps only ``k`` per page before the shuffle."""
    order = Window.partitionBy("page_id").orderBy("pre")
    return matches.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def select_first(nodes: DataFrame, selector: str | Selector, scope: str = "body", include_root: bool = False) -> DataFrame:
    return first_per_page(select(nodes, selector, scope, include_root))


def select_from(nodes: DataFrame, scopes: DataFrame, selector: str | Selector, include_root: bool = False) -> DataFrame:
    """Matches inside each scope node, with ``scope_pre``.

    Only the matched node must lie inside the scope; what the combinators refer to may lie outside.
    """
    hits = select(nodes, selector, "document", include_root=True)
    return contained(scopes, hits, include_self=include_root, name="scope")


def first_from(nodes: DataFrame, scopes: DataFrame, selector: str | Selector, include_root: bool = False) -> DataFrame:
    """First match inside each scope node."""
    hits = select_from(nodes, scopes, selector, include_root)
    order = Window.partitionBy("page_id", "scope_pre").orderBy("pre")
    return hits.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def css_matches(nodes: DataFrame, selector: str | Selector) -> DataFrame:
    """Every node with ``matches``: does this node itself match?  False for a bad selector."""
    return any_css_matches(nodes, [selector])


def any_css_matches(nodes: DataFrame, selectors: list) -> DataFrame:
    """Every node with ``matches``: does it match at least one of the selectors?

    More than ``FEW`` selectors go through a rule index, so the plan does not grow with them.
    """
    nodes = with_index(nodes)
    if len(selectors) > FEW:
        index = rule_index(nodes.sparkSession, {i: str(s) for i, s in enumerate(selectors)})
        odd = index.errors.where(F.col("error").startswith("UnsupportedSelector")).head()
        if odd is not None:
            raise UnsupportedSelector(odd.error)
        return _marked(nodes, match_index(nodes, index, "document", True).select("page_id", "pre").distinct())
    parts = []
    for s in selectors:
        try:
            parts.extend(compiled(s).parts)
        except SelectorParseError:
            pass
    if not parts:
        return nodes.withColumn("matches", F.lit(False))
    whole = Selector(", ".join(str(s) for s in selectors), parts)
    if whole.is_flat:
        return nodes.withColumn("matches", whole.column())
    return _marked(nodes, match(nodes, whole, "document", True))


def _marked(nodes: DataFrame, hits: DataFrame) -> DataFrame:
    hits = hits.select("page_id", "pre", F.lit(True).alias("_m"))
    return nodes.join(hits, ["page_id", "pre"], "left").withColumn("matches", F.coalesce("_m", F.lit(False))).drop("_m")


def page_matches(pages: DataFrame, nodes: DataFrame, selector: str | Selector, scope: str = "body") -> DataFrame:
    """``(page_id, matches)`` for every page: does some node match?"""
    hits = select(nodes, selector, scope).select("page_id").distinct().withColumn("_m", F.lit(True))
    return pages.select("page_id").join(hits, "page_id", "left").select("page_id", F.coalesce("_m", F.lit(False)).alias("matches"))


def match_counts(pages: DataFrame, matches: DataFrame) -> DataFrame:
    """``(page_id, n)`` for every page, zero included."""
    n = matches.groupBy("page_id").agg(F.count(F.lit(1)).alias("_n"))
    return pages.select("page_id").join(n, "page_id", "left").select("page_id", F.coalesce("_n", F.lit(0)).alias("n"))


def root(nodes: DataFrame) -> DataFrame:
    """The ``html`` element of each page."""
    return nodes.filter((F.col("kind") == 1) & (F.col("depth") == 1))


def head(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("kind") == 1) & (F.col("depth") == 2) & (F.col("tag") == "head"))


def body(nodes: DataFrame) -> DataFrame:
    return nodes.filter((F.col("kind") == 1) & (F.col("depth") == 2) & (F.col("tag") == "body"))
