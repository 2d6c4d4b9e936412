"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domloom.functions import props
from domloom.functions.props import attr
from domloom.operators import axes, collection, jobs, mutate, serialize
from domloom.operators import select as s
from domloom.operators.css import css_rules
from domloom.operators.index import with_index, without_index
from domloom.operators.text import text, text_shallow
from domloom.plans.rules import rule_index
from domloom.plans.selector import compile_selector
from domloom.session import shared_dir
from domloom.sources import sql as sql_face
from domloom.sources.recrawl import PageStore
from domloom.sources.shred import shred
from domloom.sources.store import buckets_for, duplicates, materialize
from domloom.sources.tokens import tokens
from domloom.streaming.extract import read_page_stream, run_extract
from domloom.suite.corpora import doc_nodes, doc_pages, page_nodes, pages, session

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _n(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _texts(hits, nodes: DataFrame) -> DataFrame:
    """``page_id, match_idx, text`` of matches."""
    values = text(hits, nodes)
    return s.with_match_idx(values).select("page_id", "match_idx", "text")


def _attrs(hits: DataFrame, name: str) -> DataFrame:
    return s.with_match_idx(hits).select("page_id", "match_idx", attr(name).alias(name))


# -- sources


@query
def shred_counts(spark, sf):
    """The shred job itself, straight from the raw pages."""
    return shred(pages(spark, sf)).groupBy(F.col("kind").cast("long").alias("kind"), "tag").agg(F.count(F.lit(1)).alias("n"))


@query
def token_counts(spark, sf):
    return _n(tokens(pages(spark, sf)), "kind", "tag")


@query
def doc_root(spark, sf):
    return s.root(page_nodes(spark, sf)).select("page_id", "tag", attr("lang").alias("lang"))


@query
def doc_head(spark, sf):
    n = page_nodes(spark, sf)
    return _n(axes.children(s.head(n), n), "page_id")


@query
def doc_body(spark, sf):
    n = page_nodes(spark, sf)
    return axes.children(s.body(n), n).select("page_id", "sib_idx", "tag")


# -- properties


@query
def kind_hist(spark, sf):
    n = page_nodes(spark, sf)
    return n.groupBy(F.col("kind").cast("long").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(props.is_element()).alias("elements"),
        F.count_if(props.is_text()).alias("texts"),
        F.count_if(props.is_document()).alias("documents"),
    )


@query
def comments(spark, sf):
    n = page_nodes(spark, sf).filter(props.is_comment())
    return n.select("page_id", props.comment_content().alias("comment"))


@query
def empty_text(spark, sf):
    return _n(doc_nodes(spark, sf).filter(props.is_empty_text_node()), "page_id")


@query
def tag_hist(spark, sf):
    return _n(page_nodes(spark, sf).filter(props.is_element()), "tag")


@query
def tag_dict(spark, sf):
    return props.tag_dictionary(page_nodes(spark, sf))


@query
def tag_resolve(spark, sf):
    names = tokens(doc_pages(spark, sf)).filter("kind = 'start'").select(F.col("tag").alias("name")).distinct()
    return props.resolve_tag_ids(page_nodes(spark, sf), names)


@query
def link_href(spark, sf):
    return _attrs(s.select(page_nodes(spark, sf), "a"), "href")


@query
def has_attr(spark, sf):
    n = page_nodes(spark, sf).filter(props.is_element())
    return n.groupBy("page_id").agg(
        F.count_if(props.has_attr("href")).alias("n_with"), F.count_if(~props.has_attr("href")).alias("n_without")
    )


@query
def id_class(spark, sf):
    n = doc_nodes(spark, sf).filter(props.is_element())
    return n.select(
        "page_id",
        "tag",
        attr("id").alias("id"),
        attr("class").alias("class"),
        F.size(props.classes()).cast("long").alias("n_classes"),
        props.has_class("doc").alias("is_doc"),
        props.has_attr("disabled").alias("has_disabled"),
        F.exists("attrs", lambda a: a["name"] == "disabled").alias("names_disabled"),
    )


@query
def has_class(spark, sf):
    return _n(page_nodes(spark, sf).filter(props.has_class("ad")), "page_id")


@query
def class_hist(spark, sf):
    return _n(doc_nodes(spark, sf).select(F.explode(props.classes()).alias("class")), "class")


@query
def attr_long(spark, sf):
    return props.attr_rows(page_nodes(spark, sf)).select("page_id", "tag", "name", "value")


@query
def css_matches(spark, sf):
    n = s.css_matches(page_nodes(spark, sf), "nav a")
    return n.groupBy("page_id").agg(F.count_if("matches").alias("n_true"), F.count_if(~F.col("matches")).alias("n_false"))


@query
def any_css_matches(spark, sf):
    n = s.any_css_matches(page_nodes(spark, sf), ["h1", "br", "!!bad!!"])
    return _n(n.filter("matches"), "page_id", "tag")


@query
def doc_matches(spark, sf):
    return s.page_matches(pages(spark, sf), page_nodes(spark, sf), "p > b")


# -- selection


@query
def sel_tag(spark, sf):
    n = page_nodes(spark, sf)
    return _texts("p", n)


@query
def sel_from(spark, sf):
    n = page_nodes(spark, sf)
    return _n(s.select_from(n, s.select(n, "article"), "body b"), "page_id")


@query
def sel_first(spark, sf):
    n = page_nodes(spark, sf)
    return text(s.select_first(n, "p"), n).select("page_id", "text")


@query
def tags(spark, sf):
    n = page_nodes(spark, sf)
    return _texts(s.tags(n, "li"), n)


@query
def compiled(spark, sf):
    n = page_nodes(spark, sf)
    selector = compile_selector("nav li > a")
    hits = s.select(n, selector)
    return hits.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.min_by(attr("href"), "pre").alias("first_href"))


@query
def first_from(spark, sf):
    n = page_nodes(spark, sf)
    hits = s.first_from(n, s.select(n, "p"), "b")
    return hits.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("parent") == F.col("scope_pre")).alias("n_outermost"))


@query
def sel_universal(spark, sf):
    return _n(s.select(page_nodes(spark, sf), "*"), "page_id")


@query
def sel_class(spark, sf):
    n = page_nodes(spark, sf)
    return _texts(".ad", n)


@query
def sel_id(spark, sf):
    return s.select(doc_nodes(spark, sf), "#doc-7").select("page_id", "tag", attr("id").alias("id"))


@query
def sel_attr(spark, sf):
    return _attrs(s.select(page_nodes(spark, sf), "a[href]"), "href")


@query
def sel_attr_eq(spark, sf):
    return _n(s.select(page_nodes(spark, sf), 'a[href="/la"]'), "page_id")


@query
def sel_attr_prefix(spark, sf):
    return _n(s.select(page_nodes(spark, sf), 'a[href^="/th"]'), "page_id")


@query
def sel_attr_suffix(spark, sf):
    return _n(s.select(page_nodes(spark, sf), 'a[href$="."]'), "page_id")


@query
def sel_attr_substr(spark, sf):
    return _n(s.select(page_nodes(spark, sf), 'a[href*="ion"]'), "page_id")


@query
def sel_attr_word(spark, sf):
    return s.select(doc_nodes(spark, sf), "div[class~=fr]").select("page_id", attr("id").alias("id"))


@query
def sel_attr_dash(spark, sf):
    hits = s.select(page_nodes(spark, sf), "html[lang|=en]", scope="document", include_root=True)
    return hits.select("page_id", attr("lang").alias("lang"))


@query
def sel_compound(spark, sf):
    return s.select(doc_nodes(spark, sf), "div.doc.en[id]").select("page_id", attr("class").alias("class"))


@query
def sel_desc(spark, sf):
    return _n(s.select(page_nodes(spark, sf), "article p b"), "page_id")


@query
def sel_child(spark, sf):
    return _n(s.select(page_nodes(spark, sf), "article > p > b"), "page_id")


@query
def sel_adjacent(spark, sf):
    n = page_nodes(spark, sf)
    return _texts("h1 + p", n)


@query
def sel_sibling(spark, sf):
    return _n(s.select(page_nodes(spark, sf), "p ~ p"), "page_id")


@query
def sel_list(spark, sf):
    hits = s.select(page_nodes(spark, sf), "h1, article p, p")
    return s.with_match_idx(hits).select("page_id", "match_idx", "tag")


@query
def sel_not(spark, sf):
    n = page_nodes(spark, sf)
    flat = _n(s.select(n, "li:not(:first-child)"), "page_id").withColumn("part", F.lit("flat"))
    nested = _n(s.select(n, "p:not(h1 + p)"), "page_id").withColumn("part", F.lit("nested"))
    return flat.unionByName(nested)


@query
def sel_is(spark, sf):
    n = page_nodes(spark, sf)
    flat = _n(jobs.match_rules(n, {"flat": ":is(h1, nav a)"}), "page_id", "rule")
    nested = s.select(n, "footer, :is(article > p) > b:first-child")
    return flat.unionByName(_n(nested, "page_id").withColumn("rule", F.lit("nested")))


@query
def sel_has(spark, sf):
    rules = {"below": "p:has(b)", "child": "p:has(> b)", "next": "p:has(+ p)", "later": "h1:has(~ p)", "none": "p:not(:has(b))", "then": "article:has(p) > h1"}
    return _n(jobs.match_rules(page_nodes(spark, sf), rules), "page_id", "rule")


@query
def sel_has_chain(spark, sf):
    """Combinators inside ``:has()``, and ``:not()`` with combinators inside that."""
    rules = {"chain": "article:has(> h1 + p b)", "not": "nav:has(a:not(li > a))", "later": "h1:has(~ p > b)", "none": "body > *:not(:has(li a))"}
    return _n(jobs.match_rules(page_nodes(spark, sf), rules), "page_id", "rule")


@query
def sel_lang(spark, sf):
    rules = {"p": "article > p:lang(en)", "other": "h1:not(:lang(en, 'de'))"}
    return _n(jobs.match_rules(page_nodes(spark, sf), rules), "page_id", "rule")


@query
def sel_nth_of(spark, sf):
    rules = {"second": "p:nth-child(2 of :has(b))", "even": "p:nth-child(2n of p)", "last": "li:nth-last-child(1 of :not(:first-child))"}
    return _n(jobs.match_rules(page_nodes(spark, sf), rules), "page_id", "rule")


@query
def sel_errors(spark, sf):
    """Two rules for each tag of the corpus, one of which does not parse: the errors, and what the others match."""
    n = page_nodes(spark, sf)
    names = n.filter(props.is_element()).select("tag").distinct()
    rules = names.selectExpr("inline(array(struct(tag as rule, tag as selector), struct(concat('bad ', tag) as rule, concat(tag, '[') as selector)))")
    index = rule_index(n.sparkSession, rules)
    hits = _n(jobs.match_rules(n, index), "rule")
    errors = index.errors.select("rule", F.lit(-1).cast("long").alias("n"))
    return hits.unionByName(errors)


@query
def sel_states(spark, sf):
    rules = {"disabled": "input:disabled", "not_enabled": "input:not(:enabled)"}
    return _n(jobs.match_rules(doc_nodes(spark, sf), rules), "page_id", "rule")


@query
def sel_links(spark, sf):
    return _n(s.select(page_nodes(spark, sf), ":link"), "page_id")


@query
def duplicate_ids(spark, sf):
    """Ids that stand in several rows: every page is read twice."""
    p = pages(spark, sf)
    return duplicates(p.unionByName(p))


@query
def attr_map(spark, sf):
    own = s.select(doc_nodes(spark, sf), "div").select("page_id", props.attributes().alias("attrs"))
    return own.select("page_id", F.col("attrs")["id"].alias("id"), F.size("attrs").cast("long").alias("n"))


@query
def remove(spark, sf):
    n = mutate.remove(page_nodes(spark, sf), "nav")
    return _n(s.select(n, "*"), "page_id")


@query
def written(spark, sf):
    """A node table written in buckets and read back."""
    n = materialize(pages(session(spark), sf))
    return _n(n, "page_id")


@query
def recrawled(spark, sf):
    """Pages crawled three times: the raw pages, then the documents' pages under the same ids, then the raw ones again, late."""
    first, second = pages(session(spark), sf), doc_pages(spark, sf)
    store = PageStore(spark, f"{shared_dir(spark)}/store", buckets_for(first.unionByName(second)))
    for crawl, stamp in ((first, 5), (second, 9), (first, 7)):
        store.upsert(crawl.withColumn("stamp", F.lit(stamp)))
    n = store.nodes()
    return _n(s.select(n, "p"), "page_id")


@query
def sel_nth_child(spark, sf):
    n = page_nodes(spark, sf)
    rules = {"fourth": "p:nth-child(4)", "even": "li:nth-child(even)", "step": "p:nth-child(3n+2)", "upto": "li:nth-child(-n+3)"}
    return _n(jobs.match_rules(n, rules), "page_id", "rule")


@query
def sel_first_last_child(spark, sf):
    n = page_nodes(spark, sf)
    rules = {"first": "li:first-child", "last": "p:last-child", "only": "a:only-child", "nth_last": "li:nth-last-child(2)"}
    hits = jobs.match_rules(n, rules)
    return text(hits.dropDuplicates(["page_id", "pre"]), n).join(hits.select("page_id", "pre", "rule"), ["page_id", "pre"]).select(
        "page_id", "rule", "text"
    )


@query
def sel_nth_of_type(spark, sf):
    n = page_nodes(spark, sf)
    rules = {"second": "p:nth-of-type(2)", "last": "p:last-of-type", "second_last": "p:nth-last-of-type(2)", "only": "p:only-of-type"}
    return _n(jobs.match_rules(n, rules), "page_id", "rule")


@query
def sel_empty(spark, sf):
    return _n(s.select(doc_nodes(spark, sf), ":empty"), "page_id", "tag")


@query
def sel_root(spark, sf):
    return s.select(page_nodes(spark, sf), ":root", "document", include_root=True).select("page_id", attr("lang").alias("lang"))


@query
def sel_invalid(spark, sf):
    return s.select(page_nodes(spark, sf), "!!invalid!!").select("page_id", "tag")


# -- axes


@query
def ax_parent(spark, sf):
    n = page_nodes(spark, sf)
    return _n(axes.parent(s.select(n, "b"), n), "page_id", "tag")


@query
def ax_first_child(spark, sf):
    n = page_nodes(spark, sf)
    return _attrs(axes.first_child(s.select(n, "li"), n), "href")


@query
def ax_last_child(spark, sf):
    n = page_nodes(spark, sf)
    return text(axes.last_child(s.select(n, "article"), n), n).select("page_id", "text")


@query
def ax_next(spark, sf):
    n = page_nodes(spark, sf)
    return text(axes.next_sibling(n.filter(props.is_comment()), n), n).select("page_id", "text")


@query
def ax_prev(spark, sf):
    n = page_nodes(spark, sf)
    return axes.prev_sibling(s.select(n, ".ad"), n).select("page_id", "data")


@query
def ax_children(spark, sf):
    n = page_nodes(spark, sf)
    return _texts(axes.children(s.select(n, "article"), n), n)


@query
def ax_descendants(spark, sf):
    n = page_nodes(spark, sf)
    return _n(axes.descendants(s.body(n), n), "page_id", "tag")


@query
def ax_ancestors(spark, sf):
    n = page_nodes(spark, sf)
    return _n(axes.ancestors(s.select(n, "a"), n), "page_id", "tag")


@query
def ax_traverse(spark, sf):
    n = page_nodes(spark, sf)
    return _n(axes.traverse(s.select(n, "ul"), n), "page_id", "tag")


@query
def ax_iter_children(spark, sf):
    n = doc_nodes(spark, sf)
    return _n(axes.iter_children(s.select(n, "div.doc, p"), n, include_text=True, skip_empty=True), "page_id", "tag")


# -- aggregates, order, collections


@query
def match_counts(spark, sf):
    return s.match_counts(pages(spark, sf), s.select(page_nodes(spark, sf), "b"))


@query
def tag_totals(spark, sf):
    """Match counts per page and tag with totals."""
    hits = s.select(page_nodes(spark, sf), "li, p")
    return hits.rollup("tag", "page_id").agg(F.count(F.lit(1)).alias("n"))


@query
def match_order(spark, sf):
    return s.with_match_idx(s.select(page_nodes(spark, sf), "a, h1, p")).select("page_id", "match_idx", "tag")


@query
def sibling_index(spark, sf):
    n = page_nodes(spark, sf)
    return n.filter(props.is_element()).select("page_id", "tag", "sib_idx", "sib_n", "el_idx", "el_rev", "ty_idx", "ty_rev")


@query
def index_split(spark, sf):
    """Sibling positions by segmented scans, pages dealt out by 16 labels."""
    n = with_index(without_index(page_nodes(spark, sf)), segment=16)
    return n.filter(props.is_element()).select("page_id", "tag", "sib_idx", "sib_n", "el_idx", "el_rev", "ty_idx", "ty_rev")


@query
def sel_split(spark, sf):
    n = without_index(page_nodes(spark, sf))
    rules = {"desc": "article p b", "next": "h1 + p", "later": "p ~ p"}
    found = [_n(s.select(n, q, segment=16), "page_id").withColumn("rule", F.lit(rule)) for rule, q in rules.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query
def coll_nodes(spark, sf):
    return collection.collection(s.select(page_nodes(spark, sf), "a")).select("page_id", "idx", attr("href").alias("href"))


@query
def coll_len(spark, sf):
    items = collection.collection(s.select(page_nodes(spark, sf), "b"))
    return collection.length(pages(spark, sf), items)


@query
def coll_get(spark, sf):
    items = collection.collection(s.select(page_nodes(spark, sf), "a"))
    return collection.get(items, 2).select("page_id", attr("href").alias("href"))


# -- text and HTML


@query
def text_own(spark, sf):
    n = page_nodes(spark, sf)
    return n.select("page_id", props.text_content().alias("text")).filter("text is not null")


@query
def text_deep(spark, sf):
    n = page_nodes(spark, sf)
    return text("article", n).select("page_id", "text")


@query
def text_nested(spark, sf):
    """Text of contexts that contain each other."""
    n = page_nodes(spark, sf)
    hits = s.select(n, "nav, ul, li")
    out = text(hits, n).join(hits.select("page_id", "pre", "tag"), ["page_id", "pre"])
    return out.select("page_id", "tag", "text")


@query
def text_strip(spark, sf):
    n = doc_nodes(spark, sf)
    return text("div", n, strip=True).select("page_id", "text")


@query
def text_shallow_parts(spark, sf):
    n = doc_nodes(spark, sf)
    return s.with_match_idx(text_shallow("li", n, separator="|", strip=True, skip_empty=True)).select(
        "page_id", "match_idx", "text"
    )


@query
def text_shallow_blank(spark, sf):
    n = doc_nodes(spark, sf)
    return text_shallow("div", n, separator="|").select("page_id", "text")


@query
def text_fragments(spark, sf):
    n = doc_nodes(spark, sf)
    out = text("div", n, strip=True, per_fragment=True, separator=" / ", skip_empty=True)
    return out.select("page_id", "text")


@query
def raw_value(spark, sf):
    n = doc_nodes(spark, sf)
    return n.filter(props.is_text()).select("page_id", F.hex(props.raw_value()).alias("raw"))


@query
def outer_html(spark, sf):
    n = page_nodes(spark, sf)
    return serialize.outer_html("nav", n).select("page_id", "html")


@query
def inner_html(spark, sf):
    n = page_nodes(spark, sf)
    return serialize.inner_html("ul", n).select("page_id", "html")


@query
def outer_html_docs(spark, sf):
    """Whole documents back to HTML: attributes with and without value, comments, escapes."""
    n = doc_nodes(spark, sf)
    return serialize.outer_html("div", n).select("page_id", "html")


@query
def pretty_outer(spark, sf):
    n = page_nodes(spark, sf)
    return serialize.outer_html_pretty("nav", n).select("page_id", "html")


@query
def pretty_inner(spark, sf):
    n = page_nodes(spark, sf)
    return serialize.inner_html_pretty("ul", n, indent=2).select("page_id", "html")


@query
def pretty_flags(spark, sf):
    n = doc_nodes(spark, sf)
    return serialize.outer_html_pretty("div", n, indent=1, skip_ws_nodes=True, skip_comment=True, raw=True, without_closing=True,
        tag_with_ns=True, without_text_indent=True,
    ).select("page_id", "html")


@query
def doctype_full(spark, sf):
    n = doc_nodes(spark, sf)
    types = n.filter("kind = 10")
    short, full = (serialize.outer_html_pretty(types, n, full_doctype=f).withColumn("flag", F.lit(f)) for f in (False, True))
    return short.unionByName(full).select("page_id", "flag", "html")


@query
def pretty_escapes(spark, sf):
    """Pretty print with escapes: every line of a document is a text node."""
    n = doc_nodes(spark, sf)
    return serialize.inner_html_pretty("p", n).select("page_id", "pre", "html").select("page_id", "html")


# -- edits


@query
def decompose(spark, sf):
    n = mutate.decompose(page_nodes(spark, sf), "article p")
    return _n(s.select(n, "*"), "page_id", "tag")


@query
def decompose_shallow(spark, sf):
    n = mutate.decompose_shallow(doc_nodes(spark, sf), "ul ul")
    return _texts("li", n)


@query
def unwrap(spark, sf):
    n = mutate.unwrap(page_nodes(spark, sf), "b")
    return serialize.inner_html("article", n).select("page_id", "html")


@query
def unwrap_nested(spark, sf):
    """Children of an unwrapped list end up under its parent."""
    n = mutate.unwrap(doc_nodes(spark, sf), "ul, ul ul > li")
    return _n(s.select(n, "div.doc > li"), "page_id")


@query
def strip_tags(spark, sf):
    n = mutate.strip_tags(page_nodes(spark, sf), ["nav", "div.ad", "script", "h1 ~ p"])
    return _n(n.filter("kind in (1, 3)"), "page_id", "tag")


@query
def append_text(spark, sf):
    n = mutate.append_text(page_nodes(spark, sf), "article, p", " [end]")
    return text("article", n).select("page_id", "text")


@query
def set_attr(spark, sf):
    n = mutate.set_attr(page_nodes(spark, sf), "nav a", "rel", "nofollow")
    return serialize.outer_html("nav", n).select("page_id", "html")


@query
def remove_attr(spark, sf):
    n = mutate.remove_attr(page_nodes(spark, sf), "a", "href")
    return serialize.inner_html("ul", n).select("page_id", "html")


@query
def clone_subtree(spark, sf):
    n = page_nodes(spark, sf)
    return mutate.clone_subtree(s.select(n, "nav"), n).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("last").alias("last"),
        F.max(F.col("depth").cast("long")).alias("depth"),
        F.count_if(F.col("parent").isNull()).alias("roots"),
    )


@query
def clone_shallow(spark, sf):
    n = page_nodes(spark, sf)
    return mutate.clone_shallow(s.select(n, "a")).groupBy("page_id").agg(
        F.count(attr("href")).alias("n"), F.max("last").alias("last")
    )


@query
def is_removed(spark, sf):
    before = page_nodes(spark, sf)
    after = mutate.decompose(before, "nav")
    return mutate.is_removed(before, after).groupBy("page_id").agg(
        F.count_if("is_removed").alias("n_removed"), F.count_if(~F.col("is_removed")).alias("n_kept")
    )


# -- jobs


@query
def match_rules(spark, sf):
    rules = {
        "links": "nav a",
        "paragraphs": "article > p",
        "bold": "p > b, b b",
        "lead": "h1 + p",
        "ads": ".ad",
    }
    return _n(jobs.match_rules(page_nodes(spark, sf), rules), "page_id", "rule")


@query
def rule_table(spark, sf):
    """A rule for every link target of the corpus, from a table, through the rule index."""
    n = page_nodes(spark, sf)
    targets = s.select(n, "a[href]").select(attr("href").alias("rule")).distinct()
    quoted = F.replace(F.replace("rule", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    rules = targets.withColumn("selector", F.concat(F.lit('nav li > a[href="'), quoted, F.lit('"]')))
    return _n(jobs.match_rules(n, rules), "page_id", "rule")


@query
def rule_many(spark, sf):
    """More selectors than fit a plan: does an item match one of them?"""
    n = page_nodes(spark, sf)
    items = [f"nav li:nth-child({i})" for i in range(1, 41)] + ["!!bad!!", "article > p:first-of-type", "h1 + p"]
    hits = s.any_css_matches(n, items).filter("matches")
    return _n(hits, "page_id", "tag")


@query
def style_rules(spark, sf):
    return jobs.style_rules(page_nodes(spark, sf)).select("page_id", "selector", "prop", "value")


@query
def style_nested(spark, sf):
    """At-rules inside each other, strings and comments with delimiters, a sheet that ends in the middle of a rule."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n, doc = F.col("n_chars").cast("string"), F.col("doc_id").cast("string")
    css = F.concat(
        F.lit("/* } "), "lang", F.lit(" { */\n@media (min-width: "), n, F.lit("px) { p."), "lang", F.lit(' { COLOR : red; content: "};{"; }\n@supports (gap: 1px) { #doc-'), doc,
        F.lit(", a { margin:0 "), n, F.lit("px } } } @import 'x;y.css'; @font-face { src: url("), "lang", F.lit(") } } h1 > b { & i, u { width: "), n,
    )
    return css_rules(docs.select(F.col("doc_id").alias("page_id"), F.lit(1).cast("long").alias("pre"), css.alias("css"))).drop("pre")


@query
def extract_fields(spark, sf):
    fields = {
        "title": ("h1", "text()", "first"),
        "first_link": ("nav a", "href", "first"),
        "third_link": ("li:nth-child(3) > a", "href", "first"),
        "links": ("nav a", "href", "all"),
        "lead": ("h1 + p", "text()", "first"),
    }
    out = jobs.extract_fields(pages(spark, sf), page_nodes(spark, sf), fields)
    return out.withColumn("links", F.array_join("links", " "))


@query
def link_edges(spark, sf):
    return jobs.link_edges(pages(spark, sf), page_nodes(spark, sf)).select("page_id", "url", "href")


@query
def link_hosts(spark, sf):
    return jobs.host_counts(jobs.link_edges(pages(spark, sf), page_nodes(spark, sf)))


@query
def clean_text(spark, sf):
    return jobs.clean_text(page_nodes(spark, sf), ["nav", "div.ad", "footer"])


@query
def stream_extract(spark, sf):
    out = shared_dir(session(spark))
    stream = read_page_stream(spark, f"{sf}/pages*.parquet")

    def links(batch):
        return s.select(shred(batch), "nav a").select("page_id", attr("href").alias("href"))

    run_extract(stream, links, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("page_id", "href")


@query
def sql_nodes(spark, sf):
    sql_face.register(spark)
    pages(spark, sf).createOrReplaceTempView("domloom_pages")
    return spark.sql(
        """SELECT p.page_id, n.tag, count(*) AS n
           FROM domloom_pages p, LATERAL html_nodes(p.html) n
           WHERE n.kind = 1 AND n.in_body GROUP BY p.page_id, n.tag"""
    )


@query
def sql_view(spark, sf):
    sql_face.create_view(page_nodes(spark, sf), "domloom_nodes")
    return spark.sql(
        """SELECT page_id, count(*) AS n, max(el_idx) AS last_item
           FROM domloom_nodes WHERE tag = 'li' AND in_body GROUP BY page_id"""
    )
