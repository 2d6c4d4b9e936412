"""The versioned store of pages that are crawled again."""

from pathlib import Path

import pytest

from domloom import select, shred, with_index
from domloom.operators.text import text
from domloom.session import shared_dir
from domloom.sources.recrawl import PageStore
from domloom.sources.store import duplicates

SCHEMA = "page_id long, html string, stamp long, bucket string"


@pytest.fixture()
def store(spark):
    return PageStore(spark, f"{shared_dir(spark)}/store", 6)


def crawl(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def titles(store, version=None):
    return {r.page_id: r.text for r in text("h1", store.nodes(version)).collect()}


def written(store, kind):
    root = Path(store.path.removeprefix("file:")) / kind
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_later_crawls_replace_earlier_ones(spark, store):
    assert store.version() is None
    assert store.upsert(crawl(spark, *[(i, f"<h1>a{i}</h1>", 10) for i in range(30)])) == 0
    # Later, earlier, equal, new, twice, removed, and rows without id or stamp.
    rows = [(1, "<h1>b1</h1>", 11), (2, "<h1>old</h1>", 9), (3, "<h1>same</h1>", 10), (100, "<h1>b100</h1>", 1), (4, "<h1>b4</h1>", 12), (4, "<h1>c4</h1>", 13), (5, None, 11), (None, "<h1>x</h1>", 99), (6, "<h1>y</h1>", None)]
    assert store.upsert(crawl(spark, *rows)) == 1
    want = {i: f"a{i}" for i in range(30)} | {1: "b1", 100: "b100", 4: "c4"}
    del want[5]
    assert titles(store) == want
    assert titles(store, 0) == {i: f"a{i}" for i in range(30)}
    store.upsert(crawl(spark, (5, "<h1>late</h1>", 10), (5, "<h1>again</h1>", 12)))
    assert titles(store)[5] == "again"
    assert duplicates(store.nodes().where("kind = 9").select("page_id")).count() == 0
    assert dict(store.stamps().collect())[4] == 13


def test_only_touched_buckets_are_written(spark, store):
    store.upsert(crawl(spark, *[(i, f"<p>{i}", 1) for i in range(60)]))
    before = written(store, "data")
    store.upsert(crawl(spark, (7, "<p>new", 2)))
    after = written(store, "data")
    fresh = set(after) - set(before)
    assert all(after[f] == t for f, t in before.items())
    assert len(fresh) == 1 and fresh.pop().startswith("write=1-")
    assert len(before) == 6 and store.nodes().select("page_id").distinct().count() == 60


def test_stored_rows_are_those_of_a_fresh_table(spark, store):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    store.upsert(pages.selectExpr("page_id", "'<p>first' as html", "1 as stamp"))
    store.upsert(pages.selectExpr("page_id", "html", "2 as stamp"))
    fresh = with_index(shred(pages))
    assert store.nodes().exceptAll(fresh).count() == 0 and fresh.exceptAll(store.nodes()).count() == 0
    assert select(store.nodes(), "nav li > a").count() == select(fresh, "nav li > a").count()


def test_nothing_to_store(spark, store):
    with pytest.raises(ValueError):
        store.nodes()
    store.upsert(spark.createDataFrame([], SCHEMA))
    assert store.nodes().count() == 0 and store.stamps().count() == 0
    assert store.upsert(crawl(spark, (1, "<p>a", 1))) == 1
    assert store.upsert(crawl(spark, (1, "<p>b", 1))) == 2
    assert [r.data for r in store.nodes().where("kind = 3").collect()] == ["a"]
