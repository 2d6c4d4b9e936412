"""Random pages, every selector form, against a plain recursive matcher; text and HTML against recursion."""

import random

import pytest

from domloom import compile_selector, materialize, select, shred
from domloom.errors import SelectorParseError
from domloom.operators import axes, jobs, mutate, serialize
from domloom.operators.select import any_css_matches
from domloom.operators.text import text
from domloom.plans.match import match_parts
from domloom.plans.rules import rule_index

TAGS = ["div", "section", "nav", "span"]


def random_html(rng, depth=0):
    out = ""
    for _ in range(rng.randint(0, 5 if depth < 4 else 1)):
        kind = rng.random()
        if kind < 0.2:
            out += rng.choice(["x", "y & z", " ", "é"])
        elif kind < 0.25:
            out += "<!--c-->"
        else:
            tag = rng.choice(TAGS)
            cls = rng.choice(["", ' class="a"', ' class="a b"', ' class="b" id="k"', ' title="x-1"'])
            cls += rng.choice([""] * 6 + [' lang="en"', ' lang="EN-us"', ' lang="fr"', ' lang=""', " lang"])
            out += f"<{tag}{cls}>{random_html(rng, depth + 1)}</{tag}>"
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(7)
    rows = [(i, f"u{i}", random_html(rng) + random_html(rng)) for i in range(60)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def nodes(pages):
    return materialize(pages, buckets=3)


class Node:
    def __init__(self, row):
        self.row, self.kids, self.up = row, [], None
        self.attrs = {a.name: a.value for a in row.attrs}
        self.cls = (self.attrs.get("class") or "").split()

    def elements(self):
        return [k for k in self.kids if k.row.kind == 1]

    def walk(self):
        yield self
        for k in self.kids:
            yield from k.walk()

    def text(self):
        return "".join(n.row.data for n in self.walk() if n.row.kind == 3)

    def html(self):
        if self.row.kind == 3:
            return self.row.data.replace("&", "&amp;")
        if self.row.kind == 8:
            return f"<!--{self.row.data}-->"
        attrs = "".join(f" {a.name}" if a.value is None else f' {a.name}="{a.value}"' for a in self.row.attrs)
        return f"<{self.row.tag}{attrs}>{''.join(k.html() for k in self.kids)}</{self.row.tag}>"


@pytest.fixture(scope="module")
def trees(nodes):
    by_page = {}
    for row in nodes.orderBy("page_id", "pre").collect():
        page = by_page.setdefault(row.page_id, {})
        page[row.pre] = Node(row)
        if row.parent is not None:
            page[row.pre].up = page[row.parent]
            page[row.parent].kids.append(page[row.pre])
    return by_page


def test_matches(node, compound):
    if node.row.kind != 1 or (compound.tag and node.row.tag != compound.tag):
        return False
    for test in compound.tests:
        if test[0] == "class":
            ok = test[1] in node.cls
        elif test[0] == "id":
            ok = node.attrs.get("id") == test[1]
        elif test[0] == "attr":
            value = node.attrs.get(test[1])
            ok = value is not None and (test[2] is None or {"|=": value == test[3] or value.startswith(test[3] + "-")}[test[2]])
        elif test[0] == "empty":
            ok = not any(k.row.kind == 1 or k.row.kind == 3 for k in node.kids)
        elif test[0] == "not":
            ok = not any(matches(node, part) for part in test[1])
        elif test[0] == "is":
            ok = any(matches(node, part) for part in test[1])
        elif test[0] == "has":
            ok = any(test_matches(other, r.step) for r in test[1] for other in related(node, r.combinator))
        elif test[0] == "lang":
            at = node
            while at is not None and "lang" not in at.attrs:
                at = at.up
            own = (at.attrs["lang"] or "").lower() if at is not None else ""
            ok = any(own == r or own.startswith(r + "-") for r in test[1])
        elif test[0] == "nth_of":
            same = [k for k in (node.up.elements() if node.up else [node]) if any(matches(k, p) for p in test[4])]
            same = same[::-1] if test[1] else same
            ok = node in same and any(test[2] * n + test[3] == same.index(node) + 1 for n in range(100))
        elif test[0] == "position":
            same = node.up.elements()
            if test[1].startswith("ty"):
                same = [k for k in same if k.row.tag == node.row.tag]
            if test[1].endswith("rev"):
                same = same[::-1]
            at = same.index(node) + 1
            ok = any(test[2] * n + test[3] == at for n in range(100))
        if not ok:
            return False
    return True


test_matches.__test__ = False


def related(node, combinator):
    if combinator == " ":
        return [n for n in node.walk() if n is not node]
    if combinator == ">":
        return node.elements()
    same = node.up.elements() if node.up else [node]
    later = same[same.index(node) + 1 :]
    return later[:1] if combinator == "+" else later


def matches(node, part, step=None):
    step = len(part.steps) - 1 if step is None else step
    if not test_matches(node, part.steps[step]):
        return False
    if step == 0:
        return True
    combinator, before = part.combinators[step], []
    if combinator in (" ", ">"):
        up = node.up
        while up is not None:
            before.append(up)
            up = up.up
    elif node.up is not None:
        same = node.up.elements()
        before = same[: same.index(node)][::-1]
    return any(matches(b, part, step - 1) for b in (before[:1] if combinator in (">", "+") else before))


SELECTORS = [
    "div", "*", ".a.b", "#k", "div.a", "[title|=x]", ":empty", "span:not(.a)", "div:not(.a, .b)",
    "div span", "div > span", "div + span", "div ~ span", "div div div", "div > div > div", "* > *", "* + *", "* ~ *", "* *",
    ".a .b > span", ".a + .a ~ div span", "section > .a + nav", "div ~ .b .a", "div > span + nav ~ div", "nav div, nav span, div",
    ":nth-child(2n+1)", "div:nth-child(3)", ":nth-last-child(-n+2)", "span:nth-of-type(2)", ":only-child", ":last-of-type",
    "div > :first-child", "div:not(div div)", "span:not(div > .a, nav span)", ":not(:not(.a)) span", "div :not(.a) + .b",
    "div:has(span)", "div:has(> .a)", ".a:has(+ div)", "div:has(~ nav)", "div:not(:has(*))", "div:has(> .a, + nav) > span", ":is(nav, div:has(.b)) span",
    "div:has(> .a span)", "div:has(.a > span + nav)", ":has(nav ~ div .b)", "nav:has(+ div > .a, > span span)", "div:has(:not(div div))", "div:not(:has(> :is(nav .a, .b + *)))",
    ":lang(en)", "div:lang(EN, fr) > span", ":not(:lang(en))", ":lang('en-us') :has(:lang(fr))", "span:lang(de)",
    ":nth-child(2 of .a)", "div:nth-child(odd of div, .b)", ":nth-last-child(-n+2 of :not(span))", ":nth-child(2n+1 of div > .a) span", ":nth-last-child(1 of :has(> div))",
    "div :not(nav > *) + :is(div ~ span, div span)",
]


@pytest.mark.parametrize("selector", SELECTORS)
def test_selectors(nodes, trees, selector):
    compiled = compile_selector(selector)
    want = {
        (page, n.row.pre)
        for page, tree in trees.items()
        for n in tree.values()
        if n.row.in_body and any(matches(n, part) for part in compiled.parts)
    }
    got = [(r.page_id, r.pre) for r in select(nodes, compiled).select("page_id", "pre").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_rules_share_one_plan(nodes):
    rules = {s: s for s in SELECTORS}
    got = {}
    for r in jobs.match_rules(nodes, rules).groupBy("rule").count().collect():
        got[r["rule"]] = r["count"]
    for s in SELECTORS[::4]:
        assert got.get(s, 0) == select(nodes, s).count(), s


def test_rule_index_against_the_plain_matcher(spark, nodes, trees):
    texts = [*SELECTORS, "[title='x-1']", "[TITLE^=X i]", "div[class~=b]", "[title$='']", ":root div", ":root", "nav, nav", "div.a:is(.b, [id], :nth-child(2)):not(nav, span)", "*"]
    index = rule_index(spark, spark.createDataFrame([(t, t) for t in texts] + [("bad", "a!"), ("two", "nav"), ("two", "nav > div")], "rule string, selector string"))
    got = {(r["rule"], r.page_id, r.pre): r["count"] for r in jobs.match_rules(nodes, index).groupBy("rule", "page_id", "pre").count().collect()}
    old = {(r["rule"], r.page_id, r.pre): r["count"] for r in match_parts(nodes, {t: compile_selector(t).parts for t in [*texts[len(SELECTORS) :], "nav > div"]}, "body", False).groupBy("rule", "page_id", "pre").count().collect()}
    want = {(t, p, n.row.pre): 1 for t in SELECTORS for p, tree in trees.items() for n in tree.values() if n.row.in_body and any(matches(n, part) for part in compile_selector(t).parts)}
    want |= {k: 1 for k in old if k[0] in texts} | {("two", *k[1:]): 1 for k in want if k[0] == "nav"} | {("two", p, n.row.pre): 1 for p, tree in trees.items() for n in tree.values() if n.row.in_body and n.row.tag == "nav"}
    want |= {("two", *k[1:]): 1 for k in old if k[0] == "nav > div"}
    assert got == want
    assert [r["rule"] for r in index.errors.collect()] == ["bad"] and index.wider and index.lists


def test_rules_of_odd_tables(spark, nodes):
    schema = "rule string, selector string, state long, key string"
    empty = spark.createDataFrame([], schema)
    assert jobs.match_rules(nodes, empty).count() == 0
    odd = spark.createDataFrame([(None, "div", 1, "k"), ("n", None, 1, "k"), ("d", "div", 2, "k"), ("d", "div", 2, "k")], schema)
    index = rule_index(spark, odd)
    assert [r["rule"] for r in index.errors.collect()] == ["n"]
    assert jobs.match_rules(nodes, index).count() == select(nodes, "div").count()
    with pytest.raises(SelectorParseError):
        jobs.match_rules(nodes, odd)
    many = [f"div:nth-child({i})" for i in range(1, 30)]
    assert any_css_matches(nodes, many).where("matches").count() == any_css_matches(nodes, ["div:nth-child(-n+29)"]).where("matches").count()


def test_unwritten_nodes_give_the_same(pages, nodes):
    fresh = shred(pages)
    for s in ("div > span + nav ~ div", ":nth-last-child(2)", ":empty"):
        assert select(fresh, s).count() == select(nodes, s).count()


def test_text_and_html(nodes, trees):
    ctx = select(nodes, "div")
    got_text = {(r.page_id, r.pre): r.text for r in text(ctx, nodes).collect()}
    got_html = {(r.page_id, r.pre): r.html for r in serialize.outer_html("div", nodes).collect()}
    divs = [(p, n) for p, t in trees.items() for n in t.values() if n.row.tag == "div"]
    assert got_text == {(p, n.row.pre): n.text() for p, n in divs}
    assert got_html == {(p, n.row.pre): n.html() for p, n in divs}


@pytest.mark.parametrize("contexts", ["*", "div, nav span"])
def test_slices_of_contexts_inside_each_other(nodes, trees, contexts):
    ctx = select(nodes, contexts)
    for given in (contexts, ctx, ctx.unionByName(ctx)):
        own = {(r.page_id, r.pre): r.text for r in text(given, nodes).collect()}
        parts = {(r.page_id, r.pre): r.text for r in text(given, nodes, per_fragment=True, separator=" é ", skip_empty=True, strip=True).collect()}
        outer = {(r.page_id, r.pre): r.html for r in serialize.outer_html(given, nodes).collect()}
        inner = {(r.page_id, r.pre): r.html for r in serialize.inner_html(given, nodes).collect()}
        want = {(p, n.row.pre): n for p, t in trees.items() for n in t.values() if n.row.in_body and any(matches(n, part) for part in compile_selector(contexts).parts)}
        assert own == {k: n.text() for k, n in want.items()}
        assert outer == {k: n.html() for k, n in want.items()}
        assert inner == {k: "".join(kid.html() for kid in n.kids) for k, n in want.items()}
        assert parts == {k: " é ".join(d.row.data.strip() for d in n.walk() if d.row.kind == 3 and d.row.data.strip()) for k, n in want.items()}


def test_contexts_without_pieces(spark, nodes):
    """A context that is no node of the table has no text, and no HTML."""
    lost = spark.createDataFrame([(999_999, 5, 9, 3, 1, None)], "page_id long, pre long, last long, depth int, kind int, data string")
    assert [(r.pre, r.text) for r in text(lost, nodes).collect()] == [(5, "")] and serialize.outer_html(lost, nodes).count() == 0
    bare = shred(spark.createDataFrame([(1, "<div><br></div><p>x"), (2, "")], "page_id long, html string"))
    assert [r.text for r in text("div", bare).collect()] == [""] and [r.html for r in serialize.inner_html("br", bare).collect()] == [""]
    assert sorted(r.text for r in text(select(bare, "div br, body > *"), bare).collect()) == ["", "", "x"]
    assert text(select(nodes, "div").limit(0), nodes).count() == 0 and serialize.inner_html("#nowhere", nodes).count() == 0


def test_axes(nodes, trees):
    got = sorted((r.page_id, r.ctx_pre, r.pre) for r in axes.descendants(select(nodes, "div"), nodes).collect())
    want = [(p, n.row.pre, d.row.pre) for p, t in trees.items() for n in t.values() if n.row.tag == "div" for d in n.walk() if d is not n]
    assert got == sorted(want)


def _check_tree(rows):
    """Labels of an edited table still describe one tree per page."""
    by_page = {}
    for r in rows:
        by_page.setdefault(r.page_id, {})[r.pre] = r
    for page in by_page.values():
        for r in page.values():
            if r.parent is not None:
                up = page[r.parent]
                assert up.pre < r.pre <= r.last <= up.last and r.depth == up.depth + 1 and up.kind in (1, 9)


def test_edits(nodes, trees):
    _check_tree(mutate.decompose(nodes, ".a > span").collect())
    unwrapped = mutate.unwrap(nodes, "div").collect()
    _check_tree(unwrapped)

    def nearest(n):
        n = n.up
        while n is not None and n.row.tag == "div":
            n = n.up
        return n and n.row.pre

    assert {(r.page_id, r.pre, r.parent) for r in unwrapped} == {
        (p, n.row.pre, nearest(n)) for p, t in trees.items() for n in t.values() if n.row.tag != "div"
    }
    added = mutate.append_text(nodes, "*", "!")
    _check_tree(added.collect())
    n_added = added.filter("node_id is null").count()
    assert n_added == select(nodes, "*").count()
    # Each element's text gains one mark per element in its subtree.
    ids = added.select("page_id", "pre", "node_id")
    got = {(r.page_id, r.node_id): r.text for r in text("*", added).join(ids, ["page_id", "pre"]).collect()}

    def marked(n):
        return "".join(marked(k) for k in n.kids) + "!" if n.row.kind == 1 else (n.row.data if n.row.kind == 3 else "")

    assert got == {(p, n.row.node_id): marked(n) for p, t in trees.items() for n in t.values() if n.row.kind == 1 and n.row.in_body}
