"""Tag, text and comment tokens straight from the page text, for queries that need no tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What follows a tag's name.  A quote opens a value only after an equals sign; what is not closed runs to the end of the
# text, so no part of the text is read again from a later start, and the scan takes linear time on any input.
_REST = r"""(?:[^=>]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))?+)*+(?:>|\z)"""
# A script or style element is one token, so its text never counts as markup.
TOKEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<[!?][^>]*+(?:>|\z)"
    rf"|<(script|style)(?=[\s/>]|\z){_REST}.*?(?:</\1(?=[\s/>]|\z)[^>]*+(?:>|\z)|\z)"
    rf"|</?+[a-z]{_REST}|</[^>]*+(?:>|\z)|[^<]++|<"
)


def tokens(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``(page_id, pos, token, kind, tag)``; kind is ``start``, ``end``, ``text``, ``comment``, ``doctype`` or ``unclosed``.

    An unclosed comment, script or style runs to the end of the page, and so does an unclosed tag, which is none.
    """
    hits = pages.select(F.col(page_id).alias("page_id"), F.posexplode(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))))
    token = F.col("col")
    tag = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))
    kind = (
        F.when(token.rlike(r"^</?[A-Za-z]") & ~token.endswith(">") & ~tag.isin("script", "style"), "unclosed")
        .when(token.startswith("<!--"), "comment")
        .when(token.rlike(r"(?i)^<!doctype"), "doctype")
        .when(token.rlike(r"^<[!?]"), "comment")
        .when(token.rlike(r"^</[^A-Za-z]"), "comment")
        .when(token.startswith("</"), "end")
        .when(token.rlike(r"^<[A-Za-z]"), "start")
        .otherwise("text")
    )
    return hits.select("page_id", "pos", token.alias("token"), kind.alias("kind"), tag.alias("tag"))
