"""Segmented scans: the same rows as the plain windows, and a huge page over many tasks."""

import re

import pytest
from pyspark.sql import functions as F

from domloom import select, with_index
from domloom.errors import UnsupportedSelector
from domloom.operators import mutate
from domloom.operators.index import without_index
from domloom.operators.segments import tasks_for
from domloom.schema import INDEX_COLUMNS, NODE_COLUMNS
from domloom.suite.corpora import doc_nodes, page_nodes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=[page_nodes, doc_nodes])
def nodes(request, spark):
    return request.param(spark, SF)


def same(a, b):
    assert a.columns == b.columns
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("segment", [3, 1000])
def test_index_columns(nodes, segment):
    assert same(with_index(without_index(nodes), segment=segment), nodes.select(*NODE_COLUMNS, *INDEX_COLUMNS))


@pytest.mark.parametrize("selector", ["p", "article p b", "div > p", "li ul li > *", "h1 + p", "p ~ p", "nav li:not(:first-child) ~ li a, article > *, p", "body * + *"])
def test_selectors(nodes, selector):
    assert same(select(without_index(nodes), selector, segment=5).select(*NODE_COLUMNS), select(nodes, selector).select(*NODE_COLUMNS))


def test_edits(nodes):
    for targets in ("li, p b", ["ul ul", "h1 ~ p"]):
        assert same(mutate.decompose(nodes, targets, segment=4), mutate.decompose(nodes, targets))
    bodies = nodes.filter("tag = 'body'")
    assert same(mutate.decompose(nodes, bodies, segment=4), mutate.decompose(nodes, bodies))


def test_what_needs_the_whole_page_is_refused(nodes):
    with pytest.raises(UnsupportedSelector):
        select(nodes, "p:has(b)", segment=5)


def test_a_huge_page_is_spread(spark):
    """One page of 300,000 nodes: a section of paragraphs with a bold word each, all children of one element."""
    n = 100_000
    frame = spark.range(n).selectExpr(
        "1L as page_id",
        """inline(array(struct(3 + 3 * id as pre, 5 + 3 * id as last, 2L as parent, 3 as depth, 1 as kind, 'p' as tag, cast(null as string) as data),
                        struct(4 + 3 * id as pre, 5 + 3 * id as last, 3 + 3 * id as parent, 4 as depth, 1 as kind, 'b' as tag, null as data),
                        struct(5 + 3 * id as pre, 5 + 3 * id as last, 4 + 3 * id as parent, 5 as depth, 3 as kind, null as tag, 'x' as data)))""",
    )
    end = 3 * n + 2
    rows = [(1, 0, end, None, 0, 9, None, None), (1, 1, end, 0, 1, 1, "html", None), (1, 2, end, 1, 2, 1, "body", None)]
    top = spark.createDataFrame(rows, "page_id long, pre long, last long, parent long, depth int, kind int, tag string, data string")
    page = top.unionByName(frame).selectExpr(
        "page_id", "pre as node_id", "pre", "last", "parent", "depth", "kind", "cast(null as string) as ns", "tag", "cast(array() as array<struct<name: string, value: string>>) as attrs", "data", "false as in_head", "depth > 2 as in_body"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hits = select(page, "body p:nth-child(2n) b", segment=10_000)
        sizes = [r["count"] for r in hits.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n // 2 and max(sizes) < n // 2 * 0.8
        indexed = with_index(page, segment=10_000).where("tag = 'p'")
        assert indexed.agg(F.max("el_idx"), F.min("el_rev"), F.sum("ty_idx"), F.count("prev_el")).first()[:] == (n, 1, n * (n + 1) // 2, n - 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    nodes = without_index(page_nodes(spark, SF))
    once = tasks_for(nodes, 10_000)
    many = nodes.unionByName(nodes.withColumn("page_id", F.expr("page_id + 1000000")))
    assert once > 2 * cores and abs(tasks_for(many, 10_000) - 2 * once) <= 1
    assert tasks_for(nodes) == tasks_for(nodes.limit(0)) == cores
    long = nodes.limit(1).withColumn("data", F.lit("x" * 50_000)).withColumn("attrs", F.expr("array(named_struct('name', 'a', 'value', repeat('y', 50000)), named_struct('name', 'b', 'value', cast(null as string)))"))
    assert tasks_for(long, 100) >= 1000


SEGMENTED = {
    "index": lambda n: with_index(n, segment=5),
    "next": lambda n: select(n, "h1 + p", segment=5),
    "later": lambda n: select(n, "p ~ p", segment=5),
    "list": lambda n: select(n, "article p b, nav > a, h1", segment=5),
    "edit": lambda n: mutate.decompose(n, n.filter("tag = 'p'"), segment=5),
}


@pytest.mark.parametrize("name", SEGMENTED)
def test_no_shuffle_of_a_scan_has_the_sessions_number(spark, monkeypatch, name):
    """All of a scan's shuffles have as many partitions as the rows need, not ``spark.sql.shuffle.partitions``."""
    nodes = without_index(page_nodes(spark, SF))
    monkeypatch.setattr(tasks_for, "__defaults__", (20_000,))
    tasks, session = tasks_for(nodes), int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks > max(session, spark.sparkContext.defaultParallelism)
    made = SEGMENTED[name](nodes)
    plan = made._jdf.queryExecution().executedPlan().toString()
    numbers = {int(n) for n in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), [A-Z]", plan)}
    assert numbers == {tasks}
