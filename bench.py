"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.  Each
query's whole result is computed and thrown away; the best of three runs counts, on node tables
written before (that job is ``shred_index_write``, best of two).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from domloom import materialize, select, select_first, shred  # noqa: E402
from domloom.functions.props import attr_rows  # noqa: E402
from domloom.operators import axes, mutate, serialize  # noqa: E402
from domloom.operators.select import body  # noqa: E402
from domloom.operators.text import text  # noqa: E402
from domloom.session import local_session  # noqa: E402
from domloom.suite import corpora  # noqa: E402
from domloom.suite.queries import QUERIES  # noqa: E402


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def timed(job, runs=3):
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        drain(job())
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus), **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="domloom-bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    pages = corpora.pages(spark, sf_dir)
    n_pages = pages.count()
    times = {"shred": timed(lambda: shred(pages.repartition(int(cpus))))}
    writes = []
    for _ in range(2):
        start = time.perf_counter()
        materialize(pages.repartition(int(cpus)), buckets=int(cpus))
        writes.append(time.perf_counter() - start)
    times["shred_index_write"] = round(min(writes), 3)
    n = corpora.page_nodes(spark, sf_dir)
    named = {
        "select_tag_p": lambda: select(n, "p"),
        "select_class": lambda: select(n, ".ad"),
        "select_compound": lambda: select(n, "article p b"),
        "select_first": lambda: select_first(n, "p"),
        "text_extraction": lambda: text("p", n),
        "inner_html": lambda: serialize.inner_html("nav", n),
        "attributes": lambda: attr_rows(select(n, "a")),
        "children_traversal": lambda: axes.children(select(n, "article"), n),
        "descendants_traversal": lambda: axes.descendants(body(n), n),
        "strip_tags": lambda: mutate.strip_tags(n, ["nav", "div.ad", "footer"]),
    }
    times.update({name: timed(job) for name, job in named.items()})
    for name in ("link_edges", "match_rules", "extract_fields", "clean_text", "outer_html_docs", "token_counts"):
        times[name] = timed(lambda q=QUERIES[name]: q(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "html_corpus_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "pages": n_pages,
                "pages_per_sec_shred": round(n_pages / times["shred"]),
            }
        )
    )


if __name__ == "__main__":
    main()
