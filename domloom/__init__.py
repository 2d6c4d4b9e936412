"""Querying, extracting from and rewriting large tables of HTML pages with Spark."""

import sys

from pyspark import cloudpickle

# Executors get the shredder's code with each job, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from domloom.errors import SelectorParseError  # noqa: E402
from domloom.operators.index import with_index  # noqa: E402
from domloom.operators.select import select, select_first  # noqa: E402
from domloom.plans.selector import compile_selector  # noqa: E402
from domloom.sources.shred import rejects, shred  # noqa: E402
from domloom.sources.store import buckets_for, duplicates, materialize, write_nodes  # noqa: E402

__all__ = [
    "SelectorParseError",
    "buckets_for",
    "compile_selector",
    "duplicates",
    "materialize",
    "rejects",
    "select",
    "select_first",
    "shred",
    "with_index",
    "write_nodes",
]
