"""Style sheets as rows: the declarations of every rule, those inside at-rules and other rules too.

The sheet's text is cut into tokens by one linear regular expression.  A running count of braces gives every token its
depth, delimiters part the tokens into segments, and a segment before a brace that opens is what the segments inside it
stand under: the latest such segment on each level above.  All of it is windows inside one sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks inside each other that are told apart; declarations deeper down are left out.
NESTED = 16

# Comments, strings, delimiters and what is between; what is not closed runs to the end.
_TOKEN = r"""(?s)/\*.*?(?:\*/|\z)|"(?:[^"\\]++|\\.)*+(?:"|\\?\z)|'(?:[^'\\]++|\\.)*+(?:'|\\?\z)|[{};]|[^{};"'/]++|/"""
_SPACE = " \t\n\f\r"
_SHEET = "partition by page_id, pre order by"
_BEFORE = "rows between unbounded preceding and 1 preceding"


def _segments(sheets: DataFrame) -> DataFrame:
    """``(page_id, pre, seg, depth, body, stop)``: the text up to a delimiter, that delimiter, and the blocks around it."""
    tokens = sheets.select("page_id", "pre", F.posexplode(F.regexp_extract_all("css", F.lit(_TOKEN), F.lit(0))).alias("pos", "token"))
    tokens = tokens.filter("not startswith(token, '/*')")
    tokens = tokens.selectExpr(
        "*",
        f"coalesce(sum(case token when '{{' then 1 when '}}' then -1 else 0 end) over ({_SHEET} pos {_BEFORE}), 0L) as _open",
        f"count(if(token in ('{{', '}}', ';'), 1, null)) over ({_SHEET} pos {_BEFORE}) as seg",
    )
    # A brace that closes nothing is passed over: the depth is counted from the lowest point so far.
    tokens = tokens.selectExpr("*", f"_open - least(0L, min(_open) over ({_SHEET} pos)) as depth")
    body = "array_join(transform(sort_array(collect_list(if(token in ('{', '}', ';'), null, struct(pos, token)))), t -> t.token), '')"
    return tokens.groupBy("page_id", "pre", "seg").agg(
        F.max("depth").alias("depth"), F.trim(F.expr(body), F.lit(_SPACE)).alias("body"), F.expr("max(if(token in ('{', '}', ';'), token, null))").alias("stop")
    )


def _within(above: Column) -> tuple[Column, Column]:
    """Of the texts of the blocks around a declaration: its selector, and the at-rules that it depends on."""
    last = F.element_at(above, -1)
    rules = F.filter(above, lambda a: ~a.startswith("@"))
    joined = F.aggregate(rules, F.lit(""), lambda up, own: F.when(up == "", own).when(own.contains("&"), F.replace(own, F.lit("&"), up)).otherwise(F.concat(up, F.lit(" "), own)))
    own = last.startswith("@") & (F.size(rules) == 0)  # declarations right inside an at-rule, as in @font-face
    conditions = F.filter(F.when(own, F.slice(above, 1, F.size(above) - 1)).otherwise(above), lambda a: a.startswith("@"))
    return F.when(own, last).otherwise(joined), F.when(F.size(conditions) > 0, F.array_join(conditions, " "))


def css_rules(sheets: DataFrame) -> DataFrame:
    """``(page_id, pre, selector, prop, value, condition)`` of every declaration in ``sheets`` (page_id, pre, css).

    ``condition`` is the at-rules around a rule, outermost first, or NULL.  A rule inside another one has the outer
    selector before its own, or in the place of its ``&``.  Declarations right inside an at-rule have that as selector.
    Comments are dropped, strings may hold any delimiter, and a sheet may end anywhere.  Sheets are told apart by
    (page_id, pre); a null or empty one gives no rows.
    """
    segments = _segments(sheets)
    opens = [f"last(if(stop = '{{' and depth = {k}, body, null), true) over ({_SHEET} seg {_BEFORE}) as _up{k}" for k in range(NESTED)]
    rows = segments.selectExpr("*", *opens)
    above = F.slice(F.array(*[f"_up{k}" for k in range(NESTED)]), F.lit(1), F.col("depth").cast("int"))
    rows = rows.filter(f"depth between 1 and {NESTED} and coalesce(stop, '') <> '{{' and body like '%:%' and not startswith(body, '@')").withColumn("_above", above)
    selector, condition = _within(F.col("_above"))
    return rows.select(
        "page_id", "pre", selector.alias("selector"), F.lower(F.trim(F.substring_index("body", ":", 1), F.lit(_SPACE))).alias("prop"),
        F.trim(F.expr("substring(body, instr(body, ':') + 1)"), F.lit(_SPACE)).alias("value"), condition.alias("condition"),
    )
