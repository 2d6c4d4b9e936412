"""Scans over pages that one task cannot hold.

The usual windows keep a page in one task.  A segmented scan deals a page out by stretches of ``segment`` labels: each stretch
is scanned on its own, its totals (one row a stretch) are carried along the page, and what comes from the stretches before
or after is added to the local result by an equi join.  It costs a shuffle of the rows for each scan, so it is for tables
with pages beyond a task's memory; everything else is better off with the plain windows.  All shuffles of a scan have the same
number of partitions, ``tasks``, which has to grow with the rows, as ``tasks_for`` does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.errors import UnsupportedSelector
from domloom.plans.selector import Selector, any_of

#: Bytes of node rows that one task of a scan sorts; 10 MB of HTML make as much where a node takes 40 bytes of it.
TASK_BYTES = 64 * 2**20
#: A node row without its strings.
_ROW_BYTES = 256

_AT = "if({v} is null, null, pre)"
_UNTIL, _BEFORE, _AFTER = (
    f"rows between {a}" for a in ("unbounded preceding and current row", "unbounded preceding and 1 preceding", "1 following and unbounded following")
)
#: kind of scan: (within a stretch, total of a stretch, totals carried to it, local and carried together)
_KINDS = {
    "max_before": ("max({v}) over ({w} " + _BEFORE + ")", "max({v})", "max({t}) over ({c} " + _BEFORE + ")", "greatest({l}, {r})"),
    "max_upto": ("max({v}) over ({w} " + _UNTIL + ")", "max({v})", "max({t}) over ({c} " + _BEFORE + ")", "greatest({l}, {r})"),
    "count_upto": ("count({v}) over ({w} " + _UNTIL + ")", "count({v})", "sum({t}) over ({c} " + _BEFORE + ")", "{l} + coalesce({r}, 0L)"),
    "count_all": ("0L", "count({v})", "sum({t}) over ({p})", "{l} + {r}"),
    "last_before": ("last({v}, true) over ({w} " + _BEFORE + ")", f"max_by({{v}}, {_AT})", "last({t}, true) over ({c} " + _BEFORE + ")", "coalesce({l}, {r})"),
    "first_after": ("first({v}, true) over ({w} " + _AFTER + ")", f"min_by({{v}}, {_AT})", "first({t}, true) over ({c} " + _AFTER + ")", "coalesce({l}, {r})"),
}


def tasks_for(nodes: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for the scans of ``nodes``, so that a task's share does not grow with the table: one for each ``task_bytes`` of
    rows, one a core at least.  Reads ``nodes`` once, to add up their strings."""
    strings = "coalesce(octet_length(data), 0) + coalesce(aggregate(attrs, 0L, (n, a) -> n + octet_length(a.name) + coalesce(octet_length(a.value), 0)), 0L)"
    total = nodes.agg(F.expr(f"sum({_ROW_BYTES} + {strings})")).head()[0] or 0
    return max(nodes.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes))


def scan(rows: DataFrame, keys: dict[str, str], segment: int, tasks: int, **columns: tuple[str, str]) -> DataFrame:
    """``rows`` with ``columns``: name -> (kind, SQL value), scanned by ``pre`` among the rows alike in ``keys``.

    ``keys``: name -> SQL, never NULL.  Kinds are those of ``_KINDS``; NULL values do not count.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    by = ", ".join([*names, "_seg"])
    dealt = rows.selectExpr("*", *[f"{sql} as {n}" for n, sql in zip(names, keys.values())], f"pre div {segment} as _seg").repartition(tasks, *names, "_seg")
    totals = dealt.groupBy(*names, "_seg").agg(*[F.expr(_KINDS[k][1].format(v=v)).alias(f"_t_{n}") for n, (k, v) in columns.items()])
    page, along = f"partition by {', '.join(names)}", f"partition by {', '.join(names)} order by _seg"
    carried = totals.repartition(tasks, *names).selectExpr(*names, "_seg", *[f"{_KINDS[k][2].format(t=f'_t_{n}', c=along, p=page)} as _r_{n}" for n, (k, _) in columns.items()])
    local = dealt.selectExpr("*", *[f"{_KINDS[k][0].format(v=v, w=f'partition by {by} order by pre')} as _l_{n}" for n, (k, v) in columns.items()])
    both = local.join(carried.repartition(tasks, *names, "_seg"), [*names, "_seg"])
    return both.selectExpr(*rows.columns, *[f"{_KINDS[k][3].format(l=f'_l_{n}', r=f'_r_{n}')} as {n}" for n, (k, _) in columns.items()])


_PAGE = {"page": "coalesce(page_id, -1L)"}
_FAMILY = {**_PAGE, "parent": "coalesce(parent, -1L)"}
_TYPED = {**_FAMILY, "tag": "coalesce(tag, '')"}


def index_steps(rows: DataFrame, segment: int, tasks: int, content: str) -> DataFrame:
    """The working columns of ``operators.index`` by segmented scans."""
    element = "if(kind = 1, pre, null)"
    rows = scan(rows, _PAGE, segment, tasks, _next=("first_after", f"if({content}, pre, null)"), _near=("last_before", "if(kind = 1, struct(pre, tag), null)"))
    rows = scan(
        rows, _FAMILY, segment, tasks, _sib=("count_upto", "pre"), sib_n=("count_all", "pre"), _el=("count_upto", element), _el_n=("count_all", element), prev_el=("last_before", element)
    )
    return scan(rows, _TYPED, segment, tasks, _ty=("count_upto", "pre"), _ty_n=("count_all", "pre"))


def match_split(nodes: DataFrame, selector: Selector, in_scope, segment: int, tasks: int) -> DataFrame:
    """Node rows matching ``selector``, each once, with no page in one task.  ``nodes`` have the index columns.

    Descendants and later siblings by segmented scans; children and neighbours by joins with the matched nodes' labels.  Compounds that other nodes decide (``:has()``, ...) are not supported.
    """
    if not all(step.alone() for part in selector.parts for step in part.steps):
        raise UnsupportedSelector(f"{selector.text!r} in a segmented scan")
    found = []
    for part in selector.parts:
        rows = nodes.filter(any_of(step.column() for step in part.steps)).withColumn("_ok", part.steps[0].column())
        for combinator, step in zip(part.combinators[1:], part.steps[1:]):
            rows = _decided(rows, combinator, segment, tasks).withColumn("_ok", F.col("_ok") & step.column())
        found.append(rows.filter(F.col("_ok") & in_scope).select(*nodes.columns))
    if len(found) == 1:
        return found[0]
    at = ["page_id", "pre"]
    labels = reduce(DataFrame.unionByName, [f.select(*at) for f in found]).repartition(tasks, *at).distinct()
    return nodes.repartition(tasks, *at).join(labels, at, "left_semi")


def _decided(rows: DataFrame, combinator: str, segment: int, tasks: int) -> DataFrame:
    """``rows`` with ``_ok`` anew: does the combinator lead from the row to one that was ``_ok``?"""
    others = [c for c in rows.columns if c != "_ok"]
    if combinator == " ":
        return scan(rows, _PAGE, segment, tasks, _reach=("max_before", "if(_ok, last, null)")).selectExpr(*others, "coalesce(_reach >= pre, false) as _ok")
    if combinator == "~":
        before = ("max_before", "if(_ok and parent is not null, pre, null)")
        return scan(rows, _FAMILY, segment, tasks, _before=before).selectExpr(*others, "_before is not null as _ok")
    # Rows without a link get one of their own, which no label is, so that they are spread as well.
    at, link = ["page_id", "_link"], "parent" if combinator == ">" else "prev_el"
    left = rows.filter("_ok").select("page_id", F.col("pre").alias("_link"), F.lit(True).alias("_met")).repartition(tasks, *at)
    rows = rows.drop("_ok").selectExpr("*", f"coalesce({link}, -1 - pre) as _link").repartition(tasks, *at)
    return rows.join(left, at, "left").selectExpr(*others, "coalesce(_met, false) as _ok")
