"""Small documents with hand-written expectations, all as pages of one table."""

import pytest
from pyspark.sql import functions as F

from domloom import SelectorParseError, compile_selector, duplicates, materialize, rejects, select, select_first
from domloom.errors import UnsupportedSelector
from domloom.functions import props
from domloom.operators import axes, collection, mutate, serialize
from domloom.operators import select as s
from domloom.operators.text import text, text_shallow
from domloom.sources.tokens import tokens

DOCS = {
    "menu": "<section><dl><dt>Tea<dd>green</dl><dl class='hot strong'><dt>Coffee<dd>black<dd>white</dl></section>",
    "recipe": """<article data-serves=4><header><h2>Soup</h2></header>
<ol><li class=prep>peel<li class="prep late">chop<li>boil<li>serve<li>eat</ol>
<footer><cite>Aunt</cite></footer></article>""",
    "table": "<table><tr><td>1<td>2<tr><td>3<td>4</table>",
    "form": "<form><input type=checkbox checked name=a><input TYPE='Radio' name=b><select disabled><option selected>x<option>y</select><button>go</button></form>",
    "urls": "<footer><a href='//cdn/x.js'>cdn</a> <a href='/y.css' hreflang='de-CH'>css</a><a name=top>top</a><a href='' hreflang=de>self</a></footer>",
    "tree": "<main><section id=s1><div><em>deep</em></div></section><section id=s2><em>flat</em><em>two</em></section></main>",
    "void": "a<hr>b<img alt='c&amp;d'><!--e--><wbr>",
    "spaces": "<pre>\n \t </pre><samp>\u00a0 z \u3000</samp>",
    "quote": "<blockquote>He said &lt;no&gt; &amp; <q>left</q>.</blockquote>",
    "code": "<script>x = a<b</script><style>i > u {}</style><kbd>p &gt; q</kbd>",
    "cross": "<div>k<i>l<b>m</i>n</b>o</div>",
    "cut": "<aside><h3>half",
    "stack": "<ins>" * 40 + "core" + "</ins>" * 40,
    "whole": "<!DOCTYPE html PUBLIC \"-//X//DTD Y//EN\" \"urn:z\"><html><head><title>Head</title></head><body><tt>Body</tt></body></html>",
    "words": "<var lang=pl title='Źródło'>Gęś <u>\U0001f986</u></var>",
    "none": "",
    "null": None,
}
IDS = {name: i for i, name in enumerate(DOCS)}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, f"u{i}", DOCS[n]) for n, i in IDS.items()], "page_id long, url string, html string")


@pytest.fixture(scope="module")
def nodes(pages):
    return materialize(pages, buckets=2)


@pytest.fixture(scope="module")
def doc(nodes):
    """Node rows of one document."""
    return lambda name: nodes.filter(F.col("page_id") == IDS[name])


def texts(n, selector, **kw):
    return [r.text for r in text(selector, n, **kw).orderBy("pre").collect()]


def column(df, name):
    return [r[name] for r in df.orderBy("pre").select(name).collect()]


@pytest.mark.parametrize(
    "name,selector,expected",
    [
        ("menu", "dd", ["green", "black", "white"]),
        ("menu", "dl.strong.hot > dd", ["black", "white"]),
        ("menu", "dl + dl dt", ["Coffee"]),
        ("menu", "dl:not(.hot) *", ["Tea", "green"]),
        ("menu", "dt ~ dd", ["green", "black", "white"]),
        ("menu", "dd + dd", ["white"]),
        ("menu", "section > dd", []),
        ("menu", "dd:only-of-type, dt:first-of-type", ["Tea", "green", "Coffee"]),
        ("recipe", "[data-serves='4'] h2", ["Soup"]),
        ("recipe", "LI:Nth-Child(2n+1)", ["peel", "boil", "eat"]),
        ("recipe", "li:nth-child( -n + 2 )", ["peel", "chop"]),
        ("recipe", "li:nth-last-child(-1n+2)", ["serve", "eat"]),
        ("recipe", "li:nth-child(even):not(.prep)", ["serve"]),
        ("recipe", "li:not(.late):not(:last-child)", ["peel", "boil", "serve"]),
        ("recipe", "[class~=late]", ["chop"]),
        ("recipe", "li[class^=prep]", ["peel", "chop"]),
        ("recipe", "[class$='te']", ["chop"]),
        ("recipe", "[class*='p l']", ["chop"]),
        ("recipe", "[class*='']", []),
        ("recipe", ":is(h2, cite)", ["Soup", "Aunt"]),
        ("recipe", "article :where(ol > li.late, footer cite)", ["chop", "Aunt"]),
        ("recipe", "title", []),
        ("table", "tr:nth-of-type(2) td", ["3", "4"]),
        ("table", "tbody > tr > td:first-child", ["1", "3"]),
        ("form", "option:checked", ["x"]),
        ("form", "select:disabled > option", ["x", "y"]),
        ("form", "button:enabled", ["go"]),
        ("form", ":not(form):not(:enabled)", ["xy"]),
        ("form", "input[type=radio i], input:checked", ["", ""]),
        ("urls", "a:any-link", ["cdn", "css", "self"]),
        ("urls", "a:not(:link)", ["top"]),
        ("urls", "[hreflang|=de]", ["css", "self"]),
        ("urls", "a[href^='//']", ["cdn"]),
        ("tree", "#s2 em", ["flat", "two"]),
        ("tree", "section > em:last-child", ["two"]),
        ("tree", "main em:only-child", ["deep"]),
        ("tree", "body section div", ["deep"]),
        ("cut", "h3", ["half"]),
        ("none", "*", []),
        ("words", "[title='Źródło']", ["Gęś \U0001f986"]),
    ],
)
def test_select(doc, name, selector, expected):
    assert texts(doc(name), selector) == expected


def test_bad_selectors_select_nothing_and_unsupported_ones_raise(doc):
    assert select(doc("menu"), "dd[").collect() == []
    for valid in ("dl:has(dt dd:focus)", "dd:dir(ltr)", "dd:hover", "dd:nth-child(2 of :visited)"):
        with pytest.raises(UnsupportedSelector):
            select(doc("menu"), valid)


@pytest.mark.parametrize("bad", ["?!", " ", "dd ~", "+ dd", "dt,, dd", "dl[x", ":nth-of-type(q)", "dd:nonsense", "dl..x", "dd)", ":is(dd", ":nth-child("])
def test_invalid_selectors(nodes, bad):
    with pytest.raises(SelectorParseError):
        compile_selector(bad)
    with pytest.raises(SelectorParseError):
        select(nodes, bad, on_error="raise")


def test_scopes(doc):
    n = doc("whole")
    assert texts(n, "title", scope="head") == ["Head"] and texts(n, "title") == []
    assert texts(n, "title, tt", scope="document") == ["Head", "Body"]
    assert column(select(n, ":root", "document", include_root=True), "tag") == ["html"]
    assert column(select(n, "body, tt", include_root=True), "tag") == ["body", "tt"]


def test_select_first_and_from(doc):
    n = doc("tree")
    assert texts(n, select_first(n, "em")) == ["deep"]
    assert select_first(n, "strong").count() == 0
    second = select(n, "#s2")
    assert texts(n, s.select_from(n, second, "main em")) == ["flat", "two"]
    assert texts(n, s.first_from(n, select(n, "section"), "em")) == ["deep", "flat"]
    assert column(s.select_from(n, second, "section", include_root=True), "tag") == ["section"]
    assert s.select_from(n, second, "section").count() == 0


def test_properties(doc):
    late = select(doc("recipe"), ".late").select(
        props.attr("id").alias("i"), props.classes().alias("c"), props.has_class("lat").alias("no"),
        props.has_class("prep").alias("yes"), props.has_attr("class").alias("has"),
    ).first()
    assert tuple(late) == (None, ["prep", "late"], False, True, True)
    box = select(doc("form"), "input").first()
    assert [(a.name, a.value) for a in box.attrs] == [("type", "checkbox"), ("checked", None), ("name", "a")]
    link = select(doc("urls"), "a[name]").select(props.attributes().alias("a")).first()
    assert link.a == {"name": "top"}
    assert {r.kind for r in doc("void").collect()} == {1, 3, 8, 9}
    assert doc("void").filter(props.is_comment()).select(props.comment_content().alias("c")).first().c == "e"
    assert doc("spaces").filter(props.is_empty_text_node()).count() == 1
    said = doc("quote").filter("kind = 3").orderBy("pre").select(props.raw_value().alias("r"), props.text_content().alias("t")).first()
    assert bytes(said.r) == b"He said <no> & " and said.t == "He said <no> & "


def test_tag_codes(spark, doc):
    codes = {r.tag: r.tag_id for r in props.tag_dictionary(doc("menu")).collect()}
    assert len(set(codes.values())) == len(codes) and codes["dl"] > 0
    names = spark.createDataFrame([("dt",), ("no-such-tag",)], "name string")
    assert {r.name: r.tag_id for r in props.resolve_tag_ids(doc("menu"), names).collect()} == {"dt": codes["dt"], "no-such-tag": None}


def test_axes(doc):
    n = doc("tree")
    two, em = select(n, "#s2"), select(n, "#s2 em")
    assert column(axes.children(two, n), "tag") == ["em", "em"]
    assert texts(n, axes.first_child(two, n)) == ["flat"] and texts(n, axes.last_child(two, n)) == ["two"]
    assert texts(n, axes.next_sibling(em, n)) == ["two"] and texts(n, axes.prev_sibling(em, n)) == ["flat"]
    assert set(column(axes.parent(em, n), "tag")) == {"section"}
    one = select(n, "#s1")
    assert column(axes.descendants(one, n).filter("kind = 1"), "tag") == ["div", "em"]
    assert column(axes.traverse(one, n).filter("kind = 1"), "tag") == ["section", "div", "em"]
    up = axes.ancestors(select(n, "div em"), n).orderBy(F.col("depth").desc())
    assert [r.tag for r in up.collect()] == ["em", "div", "section", "main", "body", "html", ""]
    word = n.filter("kind = 3 and data = 'deep'")
    for axis in (axes.first_child, axes.last_child, axes.next_sibling, axes.prev_sibling):
        assert axis(word, n).count() == 0
    q = doc("quote")
    said = select(q, "blockquote")
    assert axes.iter_children(said, q).count() == 1
    assert axes.iter_children(said, q, include_text=True).count() == 3
    blank = doc("spaces")
    assert axes.iter_children(select(blank, "pre"), blank, include_text=True, skip_empty=True).count() == 0


def test_text(doc):
    assert texts(doc("quote"), "blockquote") == ["He said <no> & left."]
    assert texts(doc("spaces"), "samp", strip=True) == ["z"]
    assert texts(doc("words"), "var, u") == ["Gęś \U0001f986", "\U0001f986"]
    assert texts(doc("quote"), "blockquote", per_fragment=True, strip=True, separator="_") == ["He said <no> &_left_."]
    # separator and skip_empty do nothing in deep text unless asked per fragment
    assert texts(doc("quote"), "blockquote", separator="_", skip_empty=True) == ["He said <no> & left."]
    note = doc("void").filter("kind = 8")
    assert texts(doc("void"), note) == ["e"]
    none = select(doc("form"), "input")
    assert texts(doc("form"), none) == ["", ""]
    assert texts(doc("quote"), doc("quote").filter("kind = 3 and data = 'left'")) == ["left"]

    def shallow(name, ctx, **kw):
        return [r.text for r in text_shallow(ctx, doc(name), **kw).orderBy("pre").collect()]

    assert shallow("tree", "div") == [""]
    assert shallow("quote", "blockquote", separator="_") == ["He said <no> & _."]
    assert shallow("quote", "blockquote", separator="_", strip=True) == ["He said <no> &_."]
    assert shallow("spaces", "pre", separator="_", strip=True, skip_empty=True) == [""]
    assert shallow("cut", doc("cut").filter("kind = 3")) == ["half"]


def html(n, ctx, inner=False, **kw):
    f = serialize.inner_html if inner else serialize.outer_html
    return [r.html for r in f(ctx, n, **kw).orderBy("pre").collect()]


def test_html(doc):
    assert html(doc("tree"), "#s1", inner=True) == ["<div><em>deep</em></div>"]
    assert html(doc("menu"), "dl:first-child") == ["<dl><dt>Tea</dt><dd>green</dd></dl>"]
    assert html(doc("quote"), "blockquote") == ["<blockquote>He said &lt;no&gt; &amp; <q>left</q>.</blockquote>"]
    assert html(doc("void"), "hr, img") == ["<hr>", '<img alt="c&amp;d">']
    assert html(doc("void"), "hr", inner=True) == [""]
    assert html(doc("void"), "body", include_root=True) == ['<body>a<hr>b<img alt="c&amp;d"><!--e--><wbr></body>']
    assert html(doc("spaces"), "pre, samp") == ["<pre> \t </pre>", "<samp>&nbsp; z \u3000</samp>"]
    assert html(doc("cross"), "div") == ["<div>k<i>l<b>m</b></i><b>n</b>o</div>"]
    assert html(doc("table"), "table") == ["<table><tbody><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></tbody></table>"]
    assert html(doc("code"), "head, body", scope="document") == [
        "<head><script>x = a<b</script><style>i > u {}</style></head>", "<body><kbd>p &gt; q</kbd></body>"
    ]
    assert html(doc("tree"), "#s1, em") == ['<section id="s1"><div><em>deep</em></div></section>', "<em>deep</em>", "<em>flat</em>", "<em>two</em>"]
    assert html(doc("whole"), doc("whole").filter("kind = 9")) == [
        "<!DOCTYPE html><html><head><title>Head</title></head><body><tt>Body</tt></body></html>"
    ]


def test_pretty_html(doc):
    def pretty(name, ctx, f=serialize.outer_html_pretty, **kw):
        return [r.html for r in f(ctx, doc(name), **kw).orderBy("pre").collect()]

    q = "blockquote"
    assert pretty("quote", q) == ["<blockquote>\n  He said &lt;no&gt; &amp; \n  <q>\n    left\n  </q>\n  .\n</blockquote>\n"]
    assert pretty("quote", "q", indent=1) == ["  <q>\n    left\n  </q>\n"]
    assert pretty("quote", q, serialize.inner_html_pretty) == ["He said &lt;no&gt; &amp; \n<q>\n  left\n</q>\n.\n"]
    assert pretty("quote", "q", without_closing=True, without_text_indent=True) == ["<q>\nleft\n"]
    assert pretty("quote", q, raw=True, tag_with_ns=True, without_closing=True)[0].startswith("<html:blockquote>\n  He said <no> & \n  <html:q>\n")
    assert pretty("spaces", "pre", skip_ws_nodes=True) == ["<pre>\n</pre>\n"]
    assert pretty("void", doc("void").filter("kind = 8"), skip_comment=True) == [""]
    types = doc("whole").filter("kind = 10")
    assert pretty("whole", types) == ["<!DOCTYPE html>\n"]
    assert pretty("whole", types, full_doctype=True) == ['<!DOCTYPE html PUBLIC "-//X//DTD Y//EN" "urn:z">\n']


def test_decompose(doc):
    n = mutate.decompose(doc("tree"), "section:first-child")
    assert column(select(n, "*"), "tag") == ["main", "section", "em", "em"]
    assert select(mutate.remove(doc("tree"), "div"), "div, div em").count() == 0
    assert column(select(mutate.decompose_shallow(doc("tree"), "div"), "em"), "tag") == ["em", "em"]
    assert html(mutate.unwrap(doc("tree"), "div"), "#s1") == ['<section id="s1"><em>deep</em></section>']
    n = mutate.unwrap(doc("stack"), "ins:not(body > ins)")
    assert html(n, "ins") == ["<ins>core</ins>"]
    gone = mutate.decompose(doc("cut"), "html", scope="document", include_root=True)
    assert [r.kind for r in gone.collect()] == [9]
    n = mutate.decompose(doc("cut"), doc("cut").filter("tag = 'body'"))
    assert [r.tag for r in select(n, "*").collect()] == ["head"]
    with pytest.raises(Exception, match="RootNode"):
        mutate.decompose(doc("cut"), doc("cut").filter("kind = 9")).collect()
    assert texts(mutate.strip_tags(doc("recipe"), ["header", ".prep", "footer"]), "li") == ["boil", "serve", "eat"]
    # the body scope leaves scripts in the head alone
    assert mutate.strip_tags(doc("code"), ["script"]).filter("tag = 'script'").count() == 1
    assert texts(mutate.decompose(doc("recipe"), "li:nth-child(1)"), "li:nth-child(1)") == ["chop"]


def test_is_removed(doc):
    before = doc("menu")
    after = mutate.decompose(before, "dt")
    assert {r.tag for r in mutate.is_removed(before, after).filter("is_removed").collect()} == {"dt", ""}
    assert mutate.removed_nodes(before, before).count() == 0


def test_append_text(doc):
    n = mutate.append_text(mutate.append_text(doc("cut"), "h3", " and"), "h3", " whole")
    assert texts(n, "h3") == ["half and whole"]
    n = mutate.append_text(doc("tree"), "#s2, #s2 em", "!")
    assert html(n, "#s2") == ['<section id="s2"><em>flat!</em><em>two!</em>!</section>']
    assert texts(n, "#s2 + *") == []
    n = mutate.append_text(doc("stack"), "ins", "x")
    assert texts(n, select_first(n, "ins")) == ["core" + "x" * 40]
    assert n.filter("node_id is null").count() == 40
    n = mutate.append_text(doc("menu"), "dd", F.concat(F.lit("#"), F.col("pre").cast("string")))
    assert all("#" in t for t in texts(n, "dd"))


def test_attr_edits(doc):
    assert html(mutate.set_attr(doc("cut"), "h3", "id", "k9"), "#k9") == ['<h3 id="k9">half</h3>']
    assert html(mutate.set_attr(doc("recipe"), ".late", "CLASS", 'q"r'), "li:nth-child(2)") == ['<li class="q&quot;r">chop</li>']
    assert html(mutate.set_attr(doc("cut"), "h3", "inert", None), "h3") == ['<h3 inert="">half</h3>']
    n = mutate.remove_attr(doc("tree"), "section", "id")
    assert html(n, "section")[1] == "<section><em>flat</em><em>two</em></section>" and select(n, "#s1").count() == 0
    assert mutate.remove_attr(n, "section", "id").count() == n.count()
    word = doc("cut").filter("kind = 3")
    with pytest.raises(Exception, match="SetAttribute"):
        mutate.set_attr(doc("cut"), word, "x", "y").collect()
    with pytest.raises(Exception, match="RemoveAttribute"):
        mutate.remove_attr(doc("cut"), word, "x").collect()
    assert mutate.set_attr(doc("cut"), word, "x", "y", on_error="skip").filter("size(attrs) > 0").count() == 0
    assert mutate.not_elements(doc("cut"), word).count() == 1
    with pytest.raises(ValueError):
        mutate.set_attr(doc("cut"), "h3", "a\0b", "x")


def test_clones(doc):
    n = doc("tree")
    copy = mutate.clone_subtree(select(n, "#s2"), n).orderBy("pre").collect()
    assert [(r.pre, r.parent, r.tag, r.data) for r in copy] == [
        (0, None, "section", None), (1, 0, "em", None), (2, 1, "", "flat"), (3, 0, "em", None), (4, 3, "", "two")
    ]
    assert [(r.tag, r.last) for r in mutate.clone_shallow(select(n, "#s2")).collect()] == [("section", 0)]


def test_matching(pages, nodes, doc):
    hit = s.css_matches(doc("cut"), "aside").filter("kind = 1").select("tag", "matches").collect()
    assert {r.tag: r.matches for r in hit} == {"html": False, "head": False, "body": False, "aside": True, "h3": False}
    assert s.any_css_matches(doc("menu"), ["table", "dd[", "section > .hot"]).filter("matches").count() == 1
    assert s.css_matches(doc("menu"), "dd[").filter("matches").count() == 0
    got = {r.page_id: r.matches for r in s.page_matches(pages, nodes, "em").collect()}
    assert got[IDS["tree"]] and not got[IDS["menu"]] and not got[IDS["null"]]
    assert {r.n for r in s.match_counts(pages, select(nodes, "li")).filter(F.col("page_id") == IDS["recipe"]).collect()} == {5}


def test_collection(pages, doc):
    items = collection.collection(select(doc("recipe"), "li"))
    assert [r.idx for r in items.orderBy("idx").collect()] == [0, 1, 2, 3, 4]
    assert texts(doc("recipe"), collection.get(items, 2)) == ["boil"]
    assert collection.get(items, 9).count() == 0
    size = collection.length(pages, items).filter(F.col("page_id").isin(IDS["recipe"], IDS["none"])).collect()
    assert {(r.len, r.is_empty) for r in size} == {(5, False), (0, True)}
    assert collection.empty_collection(doc("recipe")).count() == 0


def test_document_parts(doc):
    n = doc("whole")
    assert [s.root(n).count(), s.head(n).count(), s.body(n).count()] == [1, 1, 1]
    assert texts(doc("stack"), "ins:not(ins > ins)") == ["core"] and select(doc("stack"), "ins").count() == 40
    assert [r.tag for r in doc("none").orderBy("pre").collect()] == ["", "html", "head", "body"]


def test_rejects_and_duplicates(spark, pages):
    assert [(r.page_id, r.error) for r in rejects(pages).collect()] == [(IDS["null"], "html is null")]
    twice = spark.createDataFrame([(1, "u", "<p>"), (1, "v", "<p>"), (2, "u", "<p>"), (None, "u", "<p>"), (None, "u", "<p>")], pages.schema)
    assert [tuple(r) for r in duplicates(twice).collect()] == [(1, 2)] and duplicates(pages).count() == 0


@pytest.mark.parametrize("html", ["<a href=" + "x" * 1_000_000 + ">", "<b and " + "w " * 300_000, "<i " + "k='v' " * 5_000 + ">t</i>", "<!--" + "-" * 100_000])
def test_token_scan_takes_tags_of_any_length(spark, html):
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert "".join(r.token for r in tokens(df).orderBy("pos").collect()) == html


def test_a_page_of_half_of_all_nodes(spark):
    """One page of many nodes among small ones goes through selection, text and edits like any other."""
    rows = [(0, "u", "<ul>" + "<li><b>x</b>y</li>" * 8_000 + "</ul>")] + [(i, "u", "<ul>" + "<li><b>x</b>y</li>" * 8 + "</ul>") for i in range(1, 1000)]
    n = materialize(spark.createDataFrame(rows, "page_id long, url string, html string"), buckets=4)
    counts = {r.page_id: r["count"] for r in select(n, "ul > li b").groupBy("page_id").count().collect()}
    assert counts[0] == 8_000 and sum(counts.values()) == 8_000 + 999 * 8
    assert {r.n for r in text("ul", n).groupBy(F.length("text").alias("n")).count().collect()} == {16_000, 16}
    assert select(mutate.decompose(n, "li:nth-child(even)"), "li").filter("page_id = 0").count() == 4_000
