"""Corpus jobs: what a user runs over a whole table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.errors import SelectorParseError
from domloom.functions.props import attr, is_text
from domloom.operators.assemble import OPENING, PAIRS, SLICE, marks, pages_of, piece
from domloom.operators.css import css_rules
from domloom.operators.mutate import strip_tags
from domloom.operators.select import select
from domloom.operators.text import text
from domloom.plans.match import match_parts
from domloom.plans.rules import FEW, RuleIndex, match_index, rule_index
from domloom.plans.selector import compile_selector


def match_rules(nodes: DataFrame, rules: dict | DataFrame | RuleIndex, scope: str = "body") -> DataFrame:
    """Many selectors over all pages at once: rows ``rule`` + node columns, one per (rule, node).

    ``rules`` is a dict, a table (``rule``, ``selector``) of any size, or the index made of one by ``rule_index``.  A dict of
    up to ``FEW`` rules is written into the plan: one scan and one set of windows.  All others are an index that is joined
    with the nodes, and the plan is the same for ten rules and for ten thousand.  A selector that does not parse raises;
    ``rule_index(...).errors`` lists those of a table, and an index is matched without them.
    """
    if isinstance(rules, dict) and len(rules) <= FEW:
        compiled = {rule: compile_selector(s) for rule, s in rules.items()}
        rows = match_parts(nodes, {rule: s.parts for rule, s in compiled.items()}, scope, False)
        lists = any(len(s.parts) > 1 for s in compiled.values())
        return rows.dropDuplicates(["page_id", "pre", "rule"]) if lists else rows
    if not isinstance(rules, RuleIndex):
        rules = rule_index(nodes.sparkSession, rules)
        bad = rules.errors.head()
        if bad is not None:
            raise SelectorParseError(f"rule {bad.rule!r}: {bad.error}")
    return match_index(nodes, rules, scope)


def style_rules(nodes: DataFrame) -> DataFrame:
    """``(page_id, pre, selector, prop, value, condition)`` of the rules in every ``style`` element; see ``css_rules``.

    ``pre`` is the text node holding the rule.
    """
    # A style element holds nothing but its text, so the text rows' parents are the style elements.
    styles = select(nodes, "style", "document").select("page_id", F.col("pre").alias("parent"))
    css = nodes.filter("kind = 3").join(styles, ["page_id", "parent"], "left_semi")
    return css_rules(css.select("page_id", "pre", F.col("data").alias("css")))


def extract_fields(pages: DataFrame, nodes: DataFrame, fields: dict, scope: str = "body") -> DataFrame:
    """One row per page, one column per field.

    ``fields``: name -> ``(selector, what, which)`` with ``what`` an attribute name or ``'text()'``, and
    ``which`` ``'first'`` (a string, NULL when nothing matches) or ``'all'`` (an array in document order).
    """
    hits = match_rules(nodes, {name: spec[0] for name, spec in fields.items()}, scope)
    texts = [name for name, spec in fields.items() if spec[1] == "text()"]
    value = F.lit(None).cast("string")
    for name, (_, what, _) in fields.items():
        if what != "text()":
            value = F.when(F.col("rule") == name, attr(what)).otherwise(value)
    # What is asked of a node, evaluated once: its text, which puts two marks on the page, or an attribute's value.
    asked = hits.select("page_id", "pre", "last", "depth", F.struct("rule", F.col("rule").isin(texts).alias("text"), value.alias("value")).alias("_one"))
    ends = marks(key="a.rule")
    brought = f"struct({OPENING}, 0 as sub, cast(null as string) as piece, cast(null as bigint) as ctx, a.rule as key, a.value as note)"
    if texts:
        asked = asked.groupBy("page_id", "pre").agg(F.collect_list("_one").alias("_asked"))  # one for each field at most
        rows = nodes.join(asked, ["page_id", "pre"], "left").filter(is_text() | F.col("_asked").isNotNull())
        of_each = f"flatten(transform(coalesce(_asked, array()), a -> if(a.text, array({', '.join(ends)}), array({brought}))))"
        rows = rows.selectExpr("page_id", f"inline(concat(if(kind = 3, array({piece(OPENING, 'data')}), array()), {of_each}))")
    else:
        rows = asked.withColumnRenamed("_one", "a").selectExpr("page_id", f"inline(array({brought}))")
    brought = F.expr("sort_array(collect_list(if(ctx is null and key is not null, struct(key, pos as pre, note as value), null))) as brought")
    pages_ = pages_of(rows, brought)
    of_marks = f"transform({PAIRS}, i -> struct(marks[2 * i].key as key, marks[2 * i].ctx as pre, {SLICE.format(i='i')} as value))"
    found = pages_.selectExpr("page_id", f"concat({of_marks}, brought) as found")

    def field(name, which):
        mine = F.filter("found", lambda f: f["key"] == name)  # in document order
        return (F.get(mine, F.lit(0))["value"] if which == "first" else F.transform(mine, lambda f: f["value"])).alias(name)

    columns = [field(name, which) for name, (_, _, which) in fields.items()]
    out = pages.select("page_id").join(found.select("page_id", *columns), "page_id", "left")
    filled = [
        F.coalesce(name, F.array().cast("array<string>")).alias(name) if spec[2] == "all" else F.col(name)
        for name, spec in fields.items()
    ]
    return out.select("page_id", *filled)


def link_edges(pages: DataFrame, nodes: DataFrame, selector: str = "a", name: str = "href") -> DataFrame:
    """``(page_id, url, pre, href)``: every link with the page it is on."""
    links = select(nodes, selector).select("page_id", "pre", attr(name).alias("href")).filter("href is not null")
    return links.join(pages.select("page_id", "url"), "page_id").select("page_id", "url", "pre", "href")


def host_counts(edges: DataFrame) -> DataFrame:
    """Links per (source host, target); popular targets are counted before the shuffle."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    return edges.groupBy(host.alias("host"), "href").agg(F.count(F.lit(1)).alias("n"))


def clean_text(nodes: DataFrame, drop: list) -> DataFrame:
    """``(page_id, text)``: the body's text after dropping what the selectors match."""
    kept = strip_tags(nodes, drop)
    return text("body", kept, include_root=True).select("page_id", "text")
