"""What the physical plans must and must not contain."""

import re

import pytest

from domloom import select, shred, with_index
from domloom.operators import axes, jobs, mutate, serialize
from domloom.operators.text import text
from domloom.suite.corpora import page_nodes, pages
from domloom.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"
WITH_PYTHON = {"shred_counts", "sql_nodes"}
EAGER = {"stream_extract"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_nested_loops_and_python_only_in_the_shredder(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert ("Python" in p or "MapInArrow" in p) == (name in WITH_PYTHON)


@pytest.fixture(scope="module")
def nodes(spark):
    return page_nodes(spark, SF)


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("selector", ["p", "article p b", "article > p + p ~ p", "h1, article p"])
def test_select_on_a_written_table_does_not_shuffle(nodes, selector):
    assert "Exchange" not in plan(select(nodes, selector))


def test_text_html_axes_and_edits_do_not_shuffle_either(nodes, no_broadcast):
    for df in (
        text("p", nodes),
        serialize.outer_html("nav", nodes),
        axes.children(select(nodes, "article"), nodes),
        axes.descendants(select(nodes, "article"), nodes),
        mutate.decompose(nodes, "article p"),
        mutate.unwrap(nodes, "b"),
        mutate.append_text(nodes, "p", "x"),
    ):
        assert "Exchange" not in plan(df)


def test_selectors_need_one_shuffle_on_an_unwritten_table(spark):
    n = shred(pages(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan(select(n, "article > p + p b")))) == 1
    assert "Exchange" not in plan(select(n, "p.x[title]").select("page_id", "pre"))


def test_filters_and_columns_reach_the_scan(nodes):
    p = plan(select(nodes, "article p").select("page_id", "pre"))
    assert "In(tag, [article,p])" in p or "In(tag" in p
    schema = re.search(r"ReadSchema: struct<(.*?)>", p).group(1)
    assert "data" not in schema and "attrs" not in schema
    assert "EqualTo(id,x)" in plan(select(nodes, "#x"))


@pytest.mark.parametrize("contexts", ["p", "frame"])
def test_text_reads_text_rows(nodes, contexts):
    """Only text rows and the contexts themselves are read, however the contexts are given."""
    p = plan(text(axes.children(select(nodes, "article"), nodes) if contexts == "frame" else contexts, nodes))
    for filters in re.findall(r"PushedFilters: \[(.*?)\]", p):
        assert "kind" in filters or "parent" in filters, filters


def test_attribute_fields_need_no_interval_join(spark, nodes):
    fields = {"a": ("nav a", "href", "first"), "b": ("li a", "href", "all")}
    assert "_block" not in plan(jobs.extract_fields(pages(spark, SF), nodes, fields))


@pytest.mark.parametrize("contexts", ["*", "p", "article p b"])
def test_text_and_html_are_slices(nodes, contexts, no_broadcast):
    """One window and no join: a piece is handled once, however many contexts are around it."""
    for df in (text(contexts, nodes), serialize.outer_html(contexts, nodes), serialize.inner_html(contexts, nodes)):
        p = plan(df)
        assert p.count("Join ") == (" " in contexts) and "_block" not in p and "Exchange" not in p


def test_fields_evaluate_their_hits_once(spark, nodes):
    fields = {"a": ("nav a", "href", "first"), "b": ("h1", "text()", "first"), "c": ("li", "text()", "all")}
    p = plan(jobs.extract_fields(pages(spark, SF), nodes, fields))
    assert len(re.findall(r"FileScan parquet spark_catalog", p)) == 2  # the hits, and the text
    assert "_block" not in p


def test_clone_joins_once(nodes):
    assert plan(mutate.clone_subtree(select(nodes, "nav"), nodes)).count("Join ") == 1


def test_unused_index_windows_are_pruned(spark):
    n = with_index(shred(pages(spark, SF)))
    assert "Window" not in plan(n.filter("tag = 'p'").select("page_id", "pre"))


def test_the_plan_does_not_grow_with_the_rules(spark, nodes):
    def shape(n):
        rules = spark.range(n).selectExpr("cast(id as string) as rule", "concat('nav li:nth-child(', id, ') > a, p.c', id, ', article#x', id, ' b') as selector")
        matched = jobs.match_rules(nodes, rules)
        lines = matched._jdf.queryExecution().optimizedPlan().toString().splitlines()
        return [re.sub(r"(#|x_)\d+L?|/\S+", "", line) for line in lines]

    assert shape(10) == shape(2000)
