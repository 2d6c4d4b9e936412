"""The page tree builder: standard recoveries, and invariants on arbitrary text."""

from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from domloom.sources.pagetree import PageTree


def rows(html):
    out = defaultdict(list)
    PageTree(html).emit(1, out)
    return out


def sketch(html):
    """The body as nested text: ``tag(children)``."""
    out = rows(html)
    body = out["tag"].index("body")

    def show(i):
        kids = [j for j, p in enumerate(out["parent"]) if p == i]
        inner = " ".join(show(j) for j in kids)
        if out["kind"][i] == 3:
            return repr(out["data"][i])
        if out["kind"][i] == 8:
            return f"<!{out['data'][i]}>"
        return f"{out['tag'][i]}({inner})"

    return " ".join(show(j) for j, p in enumerate(out["parent"]) if p == body)


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<p>a<p>b", "p('a') p('b')"),
        ("<p>a<div>b</div>c", "p('a') div('b') 'c'"),
        ("</p>x</p>", "'x' p()"),
        ("a</br>b", "'a' br() 'b'"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "ul(li('a') li('b' ul(li('c'))) li('d'))"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "dl(dt('a') dd('b') dt('c'))"),
        ("<p><b>x<br><p>y</p>z", "p(b('x' br())) p(b('y')) b('z')"),
        ("<b>1<p>2</b>3</p>4", "b('1') p(b('2') '3') '4'"),
        ("<b><i>x</b>y</i>z", "b(i('x')) i('y') 'z'"),
        ("<a href=1>x<a href=2>y</a>", "a('x') a('y')"),
        ("<b><b><b><b><p>x", "b(b(b(b(p('x')))))"),
        ("<p><b><b><b><b>x<p>y", "p(b(b(b(b('x'))))) p(b(b(b('y'))))"),
        ("<table><tr><td>1<td>2<tr><th>3</table>x", "table(tbody(tr(td('1') td('2')) tr(th('3')))) 'x'"),
        ("<table><caption>c</caption><col><tbody><tr><td><b>1</table>2", "table(caption('c') colgroup(col()) tbody(tr(td(b('1'))))) '2'"),
        ("<h1>a<h2>b</h1>c", "h1('a') h2('b') 'c'"),
        ("<select><option>1<option>2<optgroup><option>3</select>", "select(option('1') option('2') optgroup(option('3')))"),
        ("<button>a<button>b", "button('a') button('b')"),
        ("<form><form>x</form>y", "form('x') 'y'"),
        ("<script>a</p><b></script>x", "'x'"),
        ("x<script>a</p><b></script>y", "'x' script('a</p><b>') 'y'"),
        ("<div><textarea>\n<b>&amp;</textarea>", "div(textarea('<b>&'))"),
        ("a<!-- b --><!>c<?php x?>d", "'a' <! b > <!> 'c' <!?php x?> 'd'"),
        ("a < b & c &amp &ampx &am; &#65;&#x42;", "'a < b & c & &x &am; AB'"),
        ("<p>a</body></html>b", "p('a' 'b')".replace("' '", "")),
        ("<svg><circle/><g>x</g></svg>y", "svg(circle() g('x')) 'y'"),
        ("<svg><p>x", "svg() p('x')"),
        ("<image src=x>", "img()"),
        ("<plaintext>a<b>", "plaintext('a<b>')"),
        ("</>x</ y>z", "'x' <! y> 'z'"),
        ("x<", "'x<'"),
        ("<div id=a", ""),
    ],
)
def test_recovery(html, expected):
    assert sketch(html) == expected


@pytest.mark.parametrize(
    "tag,expected",
    [
        ('<a href="?a=1&copy=2&amp;b&lt" x Y=\'1\' y=3>', [("href", "?a=1&copy=2&b<"), ("x", None), ("y", "1")]),
        ("<a b=c/d e=>", [("b", "c/d"), ("e", "")]),
        ("<a b = 'c' /d>", [("b", "c"), ("d", None)]),
        ("<a =x>", [("=x", None)]),
    ],
)
def test_attributes(tag, expected):
    out = rows(tag)
    assert list(out["attrs"][out["tag"].index("a")]) == expected


def test_head_and_body():
    out = rows("<title>t</title><p>x</p><style>s</style>")
    where = {t: (h, b) for t, h, b in zip(out["tag"], out["in_head"], out["in_body"]) if t}
    assert where["title"] == (True, False) and where["p"] == (False, True) and where["style"] == (False, True)
    assert where["html"] == where["head"] == where["body"] == (False, False)
    assert dict(rows("<html a=1><body b=2><html c=3><body b=9 d=4>")["attrs"][1]) == {"a": "1", "c": "3"}


PIECES = st.sampled_from(
    "<p> </p> <b> </b> <i> </i> <a> </a> <div> </div> <ul> <li> </ul> <table> <tr> <td> </table> <br> <h1> </h1> text "
    "<!-- c --> <script> </script> <title> </title> <svg> </svg> <form> </form> <button> </button> <select> <option> &amp; "
    "</body> </html> <head> <body> < > <nobr> <font> </font> <dd> <dt> </p".split()
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(PIECES, max_size=40).map("".join), st.text(alphabet="<>/=\"'! abpi-&;\0\r\n", max_size=60)))
def test_invariants(html):
    out = rows(html)
    n = len(out["pre"])
    assert out["pre"] == list(range(n)) and out["tag"][1:2] != [] and out["parent"][0] is None
    assert [t for t in out["tag"] if t in ("html", "head", "body")].count("body") == 1
    for i in range(1, n):
        p = out["parent"][i]
        assert p < i <= out["last"][i] <= out["last"][p] and out["depth"][i] == out["depth"][p] + 1
        assert out["kind"][p] in (1, 9)
    for i in range(n):
        inside = [j for j in range(n) if i < j <= out["last"][i]]
        up = {i}
        for j in range(i + 1, n):
            if out["parent"][j] in up:
                up.add(j)
        assert set(inside) == up - {i}
