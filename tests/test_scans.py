"""The text scans: what they make of broken input, and that their time grows with the input alone."""

import random
import time

import pytest

from domloom.operators.css import css_rules
from domloom.sources.tokens import tokens


def scanned(spark, html):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    return [(r.kind, r.tag, r.token) for r in tokens(df).orderBy("pos").collect()]


@pytest.mark.parametrize(
    "html,want",
    [
        ("a<!-- b", [("text", "", "a"), ("comment", "", "<!-- b")]),
        ("<!--><p>", [("comment", "", "<!-->"), ("start", "p", "<p>")]),
        ("<!-- x --!><p>", [("comment", "", "<!-- x --!>"), ("start", "p", "<p>")]),
        ("<script>if (a < b) '</p>'", [("start", "script", "<script>if (a < b) '</p>'")]),
        ("<script>1</scripty></SCRIPT x>t", [("start", "script", "<script>1</scripty></SCRIPT x>"), ("text", "", "t")]),
        ("<style/>p{}</style>t", [("start", "style", "<style/>p{}</style>"), ("text", "", "t")]),
        ("<script-x>a</script-x>", [("start", "script-x", "<script-x>"), ("text", "", "a"), ("end", "script-x", "</script-x>")]),
        ("<p title=it's>a</p>", [("start", "p", "<p title=it's>"), ("text", "", "a"), ("end", "p", "</p>")]),
        ("<p a = \"x>y\" b='>'>t", [("start", "p", "<p a = \"x>y\" b='>'>"), ("text", "", "t")]),
        ("t<p a=\"x", [("text", "", "t"), ("unclosed", "p", "<p a=\"x")]),
        ("t</p", [("text", "", "t"), ("unclosed", "p", "</p")]),
        ("a < b <3 </ x>", [("text", "", "a "), ("text", "", "<"), ("text", "", " b "), ("text", "", "<"), ("text", "", "3 "), ("comment", "", "</ x>")]),
        ("<?xml v=\"1\"?><!doctype html>", [("comment", "", "<?xml v=\"1\"?>"), ("doctype", "", "<!doctype html>")]),
        ("", []),
    ],
)
def test_broken_markup(spark, html, want):
    assert scanned(spark, html) == want


@pytest.mark.parametrize("unit", ["<!-- ", "<script>x ", "<a x ", "<a x='", "</script <script ", "<!", "</", "<a =", "<style", "--"])
def test_a_megabyte_of_broken_markup(spark, unit):
    html = unit * (1_000_000 // len(unit))
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    tokens(df).count()
    start = time.perf_counter()
    tokens(df).count()
    assert time.perf_counter() - start < 5


def rows_of(spark, css):
    df = spark.createDataFrame([(1, 2, css)], "page_id long, pre long, css string")
    return sorted((r.selector, r.prop, r.value, r.condition) for r in css_rules(df).collect())


def plain_rules(css, above=()):
    """A recursive reader for sheets of plain names: [(selector, prop, value, condition)]."""
    out, text, i = [], "", 0

    def declared(text):
        name, colon, value = text.partition(":")
        if colon and above and not text.strip().startswith("@"):
            rules = [a for a in above if not a.startswith("@")]
            own = above[-1].startswith("@") and not rules
            selector = ""
            for r in rules:
                selector = r if not selector else f"{selector} {r}"
            conditions = [a for a in (above[:-1] if own else above) if a.startswith("@")]
            out.append((above[-1] if own else selector, name.strip().lower(), value.strip(), " ".join(conditions) or None))

    while i < len(css):
        c = css[i]
        if c == "{":
            inner, used = plain_rules(css[i + 1 :], (*above, text.strip()))
            out += inner
            i += used
            text = ""
        elif c == "}":
            declared(text)
            text = ""
            if above:
                return out, i + 1
        elif c == ";":
            declared(text)
            text = ""
        else:
            text += c
        i += 1
    declared(text)
    return out, len(css)


def test_nested_sheets_against_a_recursive_reader(spark):
    rng = random.Random(4)
    sheets = ["".join(rng.choice(["{", "}", ";", "a", "b:c", "@m", " ", "p q", "\n", "x:y:z"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, 0, s) for i, s in enumerate(sheets)], "page_id long, pre long, css string")
    key = lambda r: tuple((x is not None, x) for x in r)
    got = sorted((tuple(r) for r in css_rules(df).select("page_id", "selector", "prop", "value", "condition").collect()), key=key)
    want = sorted(((i, *r) for i, s in enumerate(sheets) for r in plain_rules(s)[0]), key=key)
    assert got == want and len(want) > 100


def test_sheets_with_strings_and_comments(spark):
    assert rows_of(spark, "a{b:'x}y;\\'z';c:1}/*d{e:f}*/g{h:url(//i)}") == [("a", "b", "'x}y;\\'z'", None), ("a", "c", "1", None), ("g", "h", "url(//i)", None)]
    assert rows_of(spark, "a { &:hover { b: c } } /* open { d: e }") == [("a:hover", "b", "c", None)]
    assert rows_of(spark, "a { b: 'open }") == [("a", "b", "'open }", None)]
    assert rows_of(spark, None) == rows_of(spark, "") == []


@pytest.mark.parametrize("unit", ["a", "/* ", "a{", "}", "'", "\\", "a{b:c}", "/", '"x'])
def test_a_megabyte_of_css(spark, unit):
    css = unit * (1_000_000 // len(unit))
    df = spark.createDataFrame([(1, 2, css)], "page_id long, pre long, css string")
    css_rules(df.limit(1)).count()
    start = time.perf_counter()
    css_rules(df).count()
    assert time.perf_counter() - start < 20
