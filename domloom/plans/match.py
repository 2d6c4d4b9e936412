"""Selector matching over a node table: one scan, at most one shuffle, no joins.

Every node row that can play a part in a selector is kept once per part (``step``).  Combinators
are then decided from left to right by windows inside ``page_id``:

* descendant: subtrees nest, so a node lies under a matched one exactly when the largest ``last``
  of the matched nodes before it in document order reaches its ``pre`` -- a running maximum;
* child, next sibling: matched nodes and candidates meet in one group, keyed by the candidate's
  ``parent`` (``prev_el``) and the matched node's ``pre``;
* later sibling: a running flag among the children of one parent;
* what ``:has()``, ``:not()`` and others ask of further nodes is settled before, as flags (:mod:`domloom.plans.flags`).

All windows partition by ``page_id`` first, so they share one exchange, and none on a bucketed
table.  The cost per page is that of a sort, whatever the number of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domloom.operators.index import with_index
from domloom.operators.segments import match_split, tasks_for
from domloom.plans.flags import Flags
from domloom.plans.selector import Selector, any_of

SCOPES = ("body", "head", "document")


def scope_filter(scope: str, include_root: bool) -> Column:
    """Rows a scoped search may return.  The scope root itself counts only with ``include_root``."""
    if scope == "document":
        return F.col("depth") >= (1 if include_root else 2)
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    inside = F.col(f"in_{scope}")
    return inside | ((F.col("tag") == scope) & (F.col("depth") == 2)) if include_root else inside


def match_parts(nodes: DataFrame, rules: dict, scope: str, include_root: bool) -> DataFrame:
    """Rows ``rule`` + node columns for every (rule, node) match; ``rules`` maps a rule id to its parts."""
    nodes = with_index(nodes)
    columns = nodes.columns
    parts = [(rule, p) for rule, ps in rules.items() for p in ps]
    tags = {s.tag for _, p in parts for s in p.steps}
    flags = Flags(nodes)
    for _, part in parts:
        for step in part.steps:
            flags.settle(step)
    rows = flags.rows if None in tags else flags.rows.filter(F.col("tag").isin(sorted(tags)))
    in_scope = scope_filter(scope, include_root)
    roles, conditions = [], []
    for number, (rule, part) in enumerate(parts):
        for step, compound in enumerate(part.steps):
            final = step == len(part.steps) - 1
            cond = compound.column(flags) & in_scope if final else compound.column(flags)
            conditions.append(cond)
            roles.append((cond, f"named_struct('part', {number}, 'step', {step}, 'final', {str(final).lower()})"))
    rows = rows.filter(any_of(conditions))
    if len(roles) == 1:
        return rows.select(F.lit(parts[0][0]).alias("rule"), *columns)
    rows = rows.select(*columns, F.inline(F.array_compact(F.array(*[F.when(c, F.expr(role)) for c, role in roles]))))
    rows = rows.selectExpr("*", "step = 0 as _ok")
    for step in range(1, max(len(p.steps) for _, p in parts)):
        rows = _decide(rows, step, parts)
    rule = F.lit(parts[0][0])
    if len(rules) > 1:
        rule = F.get(F.array(*[F.lit(r) for r, _ in parts]), "part")
    return rows.filter("final").select(rule.alias("rule"), *columns)


def _decide(rows: DataFrame, step: int, parts) -> DataFrame:
    """Settle the candidates of ``step`` against the nodes matched up to ``step - 1``."""
    page = "page_id, part" if len(parts) > 1 else "page_id"
    left = f"_ok and step = {step - 1}"
    before = "order by pre, step desc rows between unbounded preceding and 1 preceding"

    def meet(link):
        key = f"case step when {step} then {link} when {step - 1} then pre end"
        return f"max({left}) over (partition by {page}, {key})"

    hits = {
        " ": f"max(if({left}, last, null)) over (partition by {page} {before}) >= pre",
        ">": meet("parent"),
        "+": meet("prev_el"),
        "~": f"max({left}) over (partition by {page}, parent {before})",
    }
    by_combinator = {}
    for number, (_, part) in enumerate(parts):
        if step < len(part.steps):
            by_combinator.setdefault(part.combinators[step], []).append(str(number))
    whens = " ".join(f"when part in ({', '.join(numbers)}) then {hits[c]}" for c, numbers in by_combinator.items())
    rows = rows.selectExpr("* except (_ok)", f"if(step = {step}, coalesce(case {whens} end, false), _ok) as _ok")
    # Settled rows stay only while they matter: as matched nodes of this step, or as results.
    return rows.filter(f"step > {step} or (_ok and (step = {step} or final))")


def match(nodes: DataFrame, selector: Selector, scope: str = "body", include_root: bool = False, segment: int | None = None) -> DataFrame:
    """Node rows matching ``selector``, each once; with ``segment`` no page has to fit a task."""
    if segment is not None:
        tasks = tasks_for(nodes)
        return match_split(with_index(nodes, segment=segment, tasks=tasks), selector, scope_filter(scope, include_root), segment, tasks)
    if selector.is_flat:
        return with_index(nodes).filter(selector.column()).filter(scope_filter(scope, include_root))
    rows = match_parts(nodes, {0: selector.parts}, scope, include_root).drop("rule")
    return rows.dropDuplicates(["page_id", "pre"]) if len(selector.parts) > 1 else rows
