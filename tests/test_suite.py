"""Every registered query against its DuckDB answer, streaming and storage."""

import pytest

from check import compare, connect
from domloom import materialize, rejects, select, shred
from domloom.session import shared_dir
from domloom.sources import sql as sql_face
from domloom.sources.tokens import tokens
from domloom.streaming.extract import read_page_stream, run_extract, stream_nodes
from domloom.suite.corpora import pages
from domloom.suite.oracles import ORACLES
from domloom.suite.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, QUERIES[name], ORACLES[name]) is None


def test_binary_html(spark):
    df = spark.createDataFrame([(1, bytearray(b"<p>a\xff</p>")), (None, bytearray(b"x"))], "page_id long, html binary")
    assert [r.data for r in shred(df).filter("kind = 3").collect()] == ["a�"]
    assert [r.error for r in rejects(df).collect()] == ["page_id is null"]


def test_tokens(spark):
    html = "<!DOCTYPE html><p class=\"a>b\">x<br/><!-- <i> --><script>var t='</p>';</script></p>"
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.kind, r.tag) for r in tokens(df).orderBy("pos").collect()]
    assert got == [("doctype", ""), ("start", "p"), ("text", ""), ("start", "br"), ("comment", ""), ("start", "script"), ("end", "p")]


def test_stream_equals_batch_and_replay_is_safe(spark, tmp_path):
    source = tmp_path / "in"
    pages(spark, SF).repartition(3).write.parquet(str(source))

    def job(batch):
        return select(shred(batch), "article > p").select("page_id", "pre")

    def run(checkpoint):
        run_extract(read_page_stream(spark, str(source), 1), job, str(tmp_path / "out"), str(checkpoint)).awaitTermination()
        return sorted(tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "out")).select("page_id", "pre").collect())

    want = sorted(tuple(r) for r in job(pages(spark, SF)).collect())
    assert run(tmp_path / "c1") == want
    assert run(tmp_path / "c1") == want
    assert run(tmp_path / "c2") == want  # every batch again: the same folders are overwritten
    assert stream_nodes(read_page_stream(spark, str(source))).isStreaming


def test_stream_without_files_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = read_page_stream(spark, str(tmp_path / "in"))
    run_extract(stream, lambda b: select(shred(b), "p").select("page_id", "pre"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("page_id", "pre").count() == 0


def test_table_function_takes_binary_pages(spark):
    sql_face.register(spark)
    spark.createDataFrame([(1, bytearray(b"<p class=k>a\xff"))], "id int, html binary").createOrReplaceTempView("domloom_binary")
    rows = spark.sql("SELECT n.tag, n.data, n.attrs FROM domloom_binary p, LATERAL html_nodes(p.html) n WHERE n.in_body").collect()
    assert [(r.tag, r.data) for r in rows] == [("p", None), ("", "a\ufffd")] and rows[0].attrs[0].value == "k"


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(base) and shared_dir(spark) != shared_dir(spark)


def test_written_table_is_bucketed_and_complete(spark):
    n = materialize(pages(spark, SF), buckets=2)
    assert n.count() == shred(pages(spark, SF)).count()
    assert n.inputFiles() and len(n.inputFiles()) <= 2
