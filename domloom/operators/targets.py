"""Which nodes an operator is aimed at.

Targets (or contexts) are a selector, a list of selectors, or any DataFrame with ``page_id, pre``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.operators.index import with_index
from domloom.plans.match import match, scope_filter
from domloom.plans.selector import Selector, compile_selector


def flagged(nodes: DataFrame, targets, scope: str = "body", include_root: bool = False) -> DataFrame:
    """``nodes`` with a never-NULL boolean ``_hit``.

    A selector without combinators is decided on the row itself: no join, no shuffle.  Anything else
    is one outer join on ``(page_id, pre)``, which a table bucketed by page answers without a shuffle.
    """
    if isinstance(targets, (list, tuple)):
        compiled = [t if isinstance(t, Selector) else compile_selector(t) for t in targets]
        targets = Selector(", ".join(t.text for t in compiled), [p for t in compiled for p in t.parts])
    if isinstance(targets, str):
        targets = compile_selector(targets)
    if isinstance(targets, Selector):
        if targets.is_flat:
            hit = targets.column() & scope_filter(scope, include_root)
            return with_index(nodes).withColumn("_hit", F.coalesce(hit, F.lit(False)))
        targets = match(nodes, targets, scope, include_root)
    marks = targets.select("page_id", "pre").distinct().withColumn("_mark", F.lit(True))
    return nodes.join(marks, ["page_id", "pre"], "left").selectExpr(*nodes.columns, "_mark is not null as _hit")
