"""String helpers as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"


def trim_unicode(value: Column) -> Column:
    """Strip Unicode white space (U+00A0, U+3000, ...) from both ends."""
    return F.regexp_replace(value, _EDGES, "")


def escape_text(value: Column) -> Column:
    out = F.replace(value, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("\u00a0"), F.lit("&nbsp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))
