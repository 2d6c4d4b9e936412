"""Buckets grow with the pages, so that a task's share of the node table does not."""

import pytest

from domloom import buckets_for, materialize, shred
from domloom.sources import recrawl
from domloom.suite.corpora import _nodes, doc_pages, pages
from domloom.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"


def shares(nodes):
    """Nodes in each file of a written table; a bucket is one file."""
    return [r["count"] for r in nodes.selectExpr("input_file_name() AS f").groupBy("f").count().collect()]


@pytest.fixture()
def plain(spark):
    """The written tables of ``SF``, with the buckets that small tables get: one a core at most."""
    for corpus in (pages, doc_pages):
        assert len(shares(_nodes(spark, SF, corpus))) <= spark.sparkContext.defaultParallelism


@pytest.fixture()
def small(monkeypatch, tmp_path):
    """Buckets of 12 kB of HTML, and a folder of its own, as the written tables are kept by folder."""
    monkeypatch.setattr(buckets_for, "__defaults__", (12_000,))
    (tmp_path / "sf").symlink_to(SF)
    return str(tmp_path / "sf")


def test_buckets_follow_the_bytes(spark):
    one = doc_pages(spark, SF)
    total = one.selectExpr("sum(octet_length(html))").head()[0]
    assert buckets_for(one, 12_000) == -(-total // 12_000)
    assert buckets_for(one.unionByName(one).unionByName(one), 12_000) == -(-3 * total // 12_000)
    cores = spark.sparkContext.defaultParallelism
    assert buckets_for(one) == buckets_for(one.limit(0)) == cores
    assert buckets_for(spark.createDataFrame([(1, None)], "page_id long, html string")) == cores
    assert buckets_for(spark.createDataFrame([(1, bytearray(b"x" * 1000))], "page_id long, html binary"), 10) == 100


def test_a_share_stays_alike_when_pages_are_repeated(spark, small):
    html = doc_pages(spark, small)
    many = html.unionByName(html.selectExpr("page_id + 1000000 AS page_id", "url", "html")).unionByName(html.selectExpr("page_id + 2000000 AS page_id", "url", "html"))
    once, thrice = shares(materialize(html)), shares(materialize(many))
    assert sum(thrice) == 3 * sum(once)
    assert max(thrice) <= 1.5 * max(once)


@pytest.mark.parametrize("corpus", [pages, doc_pages])
def test_the_suites_tables_have_buckets_by_bytes(spark, small, corpus):
    found = shares(_nodes(spark, small, corpus))
    assert len(found) > spark.sparkContext.defaultParallelism
    assert sum(found) == shred(corpus(spark, SF)).count()


@pytest.mark.parametrize("name", ["index_split", "sel_split", "match_rules", "decompose_shallow"])
def test_results_do_not_depend_on_the_buckets(spark, plain, small, name):
    def rows(sf):
        return sorted(map(str, QUERIES[name](spark, sf).collect()))

    assert rows(small) == rows(SF)


def test_the_stores_tasks_follow_the_bytes(spark, small, monkeypatch):
    """The registered query's buckets, and the tasks that a crawl is shredded in."""
    made, dealt = [], []
    monkeypatch.setattr(recrawl, "shred", lambda p: (dealt.append(p.rdd.getNumPartitions()), shred(p))[1])
    write = recrawl.PageStore.upsert
    monkeypatch.setattr(recrawl.PageStore, "upsert", lambda self, *a: (made.append(self.buckets), write(self, *a))[1])
    QUERIES["recrawled"](spark, small).count()
    both = pages(spark, SF).unionByName(doc_pages(spark, SF))
    assert set(made) == {buckets_for(both, 12_000)}
    assert max(dealt) == buckets_for(doc_pages(spark, SF), 12_000) > spark.sparkContext.defaultParallelism

