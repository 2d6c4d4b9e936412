"""The same answers in DuckDB SQL, from the raw page text and the source tables.

The raw pages follow one regular pattern, so plain regular expressions read them exactly; the
document pages are a function of ``documents``, so their answers come from that table's columns.
No tree is built here.
"""

from __future__ import annotations


def _decoded(x: str) -> str:
    """The character references that occur in the pages, ``&amp;`` (at a cut, without ``;``) last."""
    for ref, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        x = f"replace({x}, '{ref}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _escaped(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), chr(160), '&nbsp;'), '<', '&lt;'), '>', '&gt;')"


def _reprinted(x: str) -> str:
    """Page source as the serializer prints it: the texts hold no other character to escape."""
    return f"replace({_decoded(x)}, '&', '&amp;')"


# The parts of each page: link targets, paragraphs with a bold flag, title, ad and footer sources.
PARTS = """parts AS (
  SELECT page_id, url, html,
    regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs,
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS anchors,
    regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS article,
    regexp_extract(html, '<title>([^<]*)', 1) AS title,
    regexp_extract(html, '<h1>([^<]*)', 1) AS h1,
    regexp_extract(html, '<div class="ad">([^<]*)', 1) AS ad,
    regexp_extract(html, '<footer>([^<]*)', 1) AS footer,
    regexp_extract(html, '<!--(.*?)-->', 1) AS comment,
    regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang
  FROM pages)"""
# One row per paragraph and footer.  An unclosed b is opened again in later blocks, three deep at most:
# n_b is how many b elements the block holds.
BLOCKS = f"""{PARTS}, events AS (
  SELECT page_id, unnest(ev) AS ev, generate_subscripts(ev, 1) AS i
  FROM (SELECT page_id, regexp_extract_all(html, '<p><b>|<p>|<footer>') AS ev FROM parts)),
blocks AS (
  SELECT page_id, i, ev, CASE WHEN ev = '<footer>' THEN 'footer' ELSE 'p' END AS tag,
    least(3, count(*) FILTER (ev = '<p><b>') OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      + CASE WHEN ev = '<p><b>' THEN 1 ELSE 0 END AS n_b
  FROM events)"""
PARAS = f"""{PARTS}, paras AS (
  SELECT page_id, i, {_decoded('t')} AS text, n FROM (
    SELECT page_id, unnest(ps) AS t, generate_subscripts(ps, 1) AS i, len(ps) AS n
    FROM (SELECT page_id, regexp_extract_all(article, '<p>(?:<b>)?([^<]*)', 1) AS ps FROM parts)))"""
LINKS = f"""{PARTS}, links AS (
  SELECT page_id, url, unnest(hrefs) AS href, unnest(anchors) AS anchor, generate_subscripts(hrefs, 1) AS i, len(hrefs) AS n FROM parts)"""
# Elements per page and tag, body only; the head has meta, title, style and script.
BODY_TAGS = f"""{BLOCKS}, body_tags AS (
  SELECT page_id, unnest(['nav', 'ul', 'div', 'article', 'h1', 'footer']) AS tag, 1 AS n FROM parts
  UNION ALL SELECT page_id, unnest(['li', 'a']), len(hrefs) FROM parts WHERE len(hrefs) > 0
  UNION ALL SELECT page_id, 'p', count(*) FROM blocks WHERE tag = 'p' GROUP BY ALL
  UNION ALL SELECT page_id, 'b', sum(n_b) FROM blocks GROUP BY ALL HAVING sum(n_b) > 0
  UNION ALL SELECT page_id, 'br', count(*) FROM blocks WHERE ev = '<p><b>' GROUP BY ALL)"""
# Text nodes of the body: one per link, ad, h1, paragraph and footer.
TAGS = f"""{BODY_TAGS}, tags AS (
  SELECT * FROM body_tags UNION ALL SELECT page_id, unnest(['html', 'head', 'body', 'meta', 'title', 'style', 'script']), 1 FROM parts),
texts AS (
  SELECT page_id, 6 + len(hrefs) + len(regexp_extract_all(article, '<p>')) AS n FROM parts)"""
LINES = """lines AS (
  SELECT doc_id, lang, source, n_chars, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, len(ls) AS n
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"""
BLANK = "'^[ \\t\\n\\f\\r]*$'"


def _p(sql: str) -> str:
    return f"WITH {PARTS} {sql}"


ORACLES = {
    "shred_counts": f"""WITH {TAGS}
        SELECT 1::BIGINT AS kind, tag, sum(n)::BIGINT AS n FROM tags GROUP BY ALL
        UNION ALL SELECT 3, '', sum(n)::BIGINT FROM texts
        UNION ALL SELECT unnest([8, 9, 10]), '', count(*) FROM pages""",
    "token_counts": f"""WITH {PARTS}, markup AS (
          SELECT unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '<(script|style)>.*?</(script|style)>', '', 'g'), '<!.*?>', '', 'g'),
                 '</?[a-z0-9]+|>[^<]+')) AS t FROM parts)
        SELECT CASE WHEN t LIKE '</%' THEN 'end' WHEN t LIKE '<%' THEN 'start' ELSE 'text' END AS kind,
               CASE WHEN t LIKE '<%' THEN ltrim(t, '</') ELSE '' END AS tag, count(*) AS n FROM markup GROUP BY ALL
        UNION ALL SELECT 'start', unnest(['script', 'style']), count(*) FROM parts
        UNION ALL SELECT unnest(['comment', 'doctype']), '', count(*) FROM parts""",
    "doc_root": _p("SELECT page_id, 'html' AS tag, lang FROM parts"),
    "doc_head": _p("SELECT page_id, len(regexp_extract_all(html, '<(meta|title|style|script)[ >]'))::BIGINT AS n FROM parts"),
    "doc_body": _p(
        "SELECT page_id, unnest([1, 2, 3, 4, 5])::BIGINT AS sib_idx, unnest(['nav', '', 'div', 'article', 'footer']) AS tag FROM parts"
    ),
    "kind_hist": f"""WITH {TAGS}, k AS (
          SELECT 1 AS kind, sum(n) AS n FROM tags UNION ALL SELECT 3, sum(n) FROM texts
          UNION ALL SELECT unnest([8, 9, 10]), count(*) FROM pages)
        SELECT kind::BIGINT AS kind, n::BIGINT AS n, (CASE WHEN kind = 1 THEN n ELSE 0 END)::BIGINT AS elements,
          (CASE WHEN kind = 3 THEN n ELSE 0 END)::BIGINT AS texts, (CASE WHEN kind = 9 THEN n ELSE 0 END)::BIGINT AS documents FROM k""",
    "comments": _p("SELECT page_id, comment FROM parts"),
    "empty_text": f"""WITH {LINES}
        SELECT doc_id AS page_id, (1 + count(*) + count(*) FILTER (line <> '' AND regexp_matches(line, {BLANK})))::BIGINT AS n
        FROM lines GROUP BY ALL""",
    "tag_hist": f"WITH {TAGS} SELECT tag, sum(n)::BIGINT AS n FROM tags GROUP BY ALL",
    "tag_dict": f"WITH {TAGS} SELECT DISTINCT tag, ('0x' || substr(md5(tag), 1, 15))::BIGINT AS tag_id FROM tags",
    "tag_resolve": f"""WITH {TAGS}, names AS (SELECT unnest(['div', 'p', 'input', 'ul', 'li']) AS name WHERE EXISTS (FROM documents))
        SELECT name, CASE WHEN name IN (SELECT tag FROM tags) THEN ('0x' || substr(md5(name), 1, 15))::BIGINT END AS tag_id FROM names""",
    "link_href": f"WITH {LINKS} SELECT page_id, i::BIGINT AS match_idx, href FROM links",
    "has_attr": f"""WITH {TAGS} SELECT page_id, len(hrefs)::BIGINT AS n_with, (total - len(hrefs))::BIGINT AS n_without
        FROM parts JOIN (SELECT page_id, sum(n) AS total FROM tags GROUP BY ALL) USING (page_id)""",
    "id_class": """SELECT doc_id AS page_id, 'div' AS tag, 'doc-' || doc_id AS id, 'doc ' || lang || '  ' || source AS class,
          3::BIGINT AS n_classes, true AS is_doc, false AS has_disabled, false AS names_disabled FROM documents
        UNION ALL SELECT doc_id, 'input', NULL, NULL, 0, false, false, true FROM documents
        UNION ALL SELECT doc_id, 'ul', NULL, 'meta', 1, false, false, false FROM documents
        UNION ALL SELECT doc_id, unnest(['html', 'head', 'body', 'ul', 'li', 'li', 'li']), NULL, NULL, 0, false, false, false FROM documents
        UNION ALL SELECT doc_id, 'p', NULL, NULL, 0, false, false, false FROM (SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents)""",
    "has_class": """SELECT page_id, len(regexp_extract_all(html, 'class="ad"'))::BIGINT AS n FROM pages""",
    "class_hist": """SELECT class, count(*) AS n FROM (SELECT unnest(['doc', 'meta', lang, source]) AS class FROM documents) GROUP BY ALL""",
    "attr_long": f"""WITH {LINKS} SELECT page_id, 'html' AS tag, 'lang' AS name, lang AS value FROM parts
        UNION ALL SELECT page_id, 'meta', 'charset', 'utf-8' FROM parts
        UNION ALL SELECT page_id, 'div', 'class', 'ad' FROM parts
        UNION ALL SELECT page_id, 'a', 'href', href FROM links""",
    "css_matches": f"""WITH {TAGS}, total AS (
          SELECT page_id, sum(n) AS n FROM (SELECT page_id, n FROM tags UNION ALL SELECT page_id, n + 3 FROM texts) GROUP BY ALL)
        SELECT page_id, len(hrefs)::BIGINT AS n_true, (n - len(hrefs))::BIGINT AS n_false FROM parts JOIN total USING (page_id)""",
    "any_css_matches": f"WITH {TAGS} SELECT page_id, tag, n::BIGINT AS n FROM tags WHERE tag IN ('h1', 'br')",
    "doc_matches": "SELECT page_id, contains(html, '<p><b>') AS matches FROM pages",
    "sel_tag": f"WITH {PARAS} SELECT page_id, i::BIGINT AS match_idx, text FROM paras",
    "sel_from": f"WITH {BLOCKS} SELECT page_id, sum(n_b)::BIGINT AS n FROM blocks WHERE tag = 'p' GROUP BY ALL HAVING sum(n_b) > 0",
    "sel_first": f"WITH {PARAS} SELECT page_id, text FROM paras WHERE i = 1",
    "tags": f"WITH {LINKS} SELECT page_id, i::BIGINT AS match_idx, {_decoded('anchor')} AS text FROM links",
    "compiled": _p("SELECT page_id, len(hrefs)::BIGINT AS n, hrefs[1] AS first_href FROM parts WHERE len(hrefs) > 0"),
    "first_from": f"WITH {BLOCKS} SELECT page_id, count(*) AS n, count(*) AS n_outermost FROM blocks WHERE tag = 'p' AND n_b > 0 GROUP BY ALL",
    "sel_universal": f"WITH {BODY_TAGS} SELECT page_id, sum(n)::BIGINT AS n FROM body_tags GROUP BY ALL",
    "sel_class": _p(f"SELECT page_id, 1::BIGINT AS match_idx, {_decoded('ad')} AS text FROM parts"),
    "sel_id": "SELECT doc_id AS page_id, 'div' AS tag, 'doc-7' AS id FROM documents WHERE doc_id = 7",
    "sel_attr": f"WITH {LINKS} SELECT page_id, i::BIGINT AS match_idx, href FROM links",
    "sel_attr_eq": f"WITH {LINKS} SELECT page_id, count(*) AS n FROM links WHERE href = '/la' GROUP BY ALL",
    "sel_attr_prefix": f"WITH {LINKS} SELECT page_id, count(*) AS n FROM links WHERE starts_with(href, '/th') GROUP BY ALL",
    "sel_attr_suffix": f"WITH {LINKS} SELECT page_id, count(*) AS n FROM links WHERE suffix(href, '.') GROUP BY ALL",
    "sel_attr_substr": f"WITH {LINKS} SELECT page_id, count(*) AS n FROM links WHERE contains(href, 'ion') GROUP BY ALL",
    "sel_attr_word": "SELECT doc_id AS page_id, 'doc-' || doc_id AS id FROM documents WHERE lang = 'fr'",
    "sel_attr_dash": _p("SELECT page_id, lang FROM parts WHERE lang = 'en' OR starts_with(lang, 'en-')"),
    "sel_compound": "SELECT doc_id AS page_id, 'doc en  ' || source AS class FROM documents WHERE lang = 'en'",
    "sel_desc": f"WITH {BLOCKS} SELECT page_id, sum(n_b)::BIGINT AS n FROM blocks WHERE tag = 'p' GROUP BY ALL HAVING sum(n_b) > 0",
    "sel_child": f"WITH {BLOCKS} SELECT page_id, count(*) AS n FROM blocks WHERE tag = 'p' AND n_b > 0 GROUP BY ALL",
    "sel_adjacent": f"WITH {PARAS} SELECT page_id, 1::BIGINT AS match_idx, text FROM paras WHERE i = 1",
    "sel_sibling": f"WITH {PARAS} SELECT page_id, count(*) AS n FROM paras WHERE i > 1 GROUP BY ALL",
    "sel_list": f"""WITH {PARAS} SELECT page_id, (i + 1)::BIGINT AS match_idx, 'p' AS tag FROM paras
        UNION ALL SELECT page_id, 1, 'h1' FROM parts""",
    "sel_is": f"""WITH {BLOCKS}, hits AS (
          SELECT page_id, 'flat' AS rule, len(hrefs) + 1 AS n FROM parts
          UNION ALL SELECT page_id, 'nested', count(*) FILTER (tag = 'footer' OR n_b > 0) FROM blocks GROUP BY ALL)
        SELECT page_id, rule, n::BIGINT AS n FROM hits WHERE n > 0""",
    "sel_has": f"""WITH {BLOCKS}, own AS (SELECT page_id, n_b > 0 AS bold, count(*) OVER (PARTITION BY page_id) AS n FROM blocks WHERE tag = 'p')
        SELECT page_id, unnest(['below', 'child']) AS rule, count(*) AS n FROM own WHERE bold GROUP BY page_id
        UNION ALL SELECT page_id, 'none', count(*) FROM own WHERE NOT bold GROUP BY page_id
        UNION ALL SELECT page_id, 'next', n - 1 FROM own GROUP BY page_id, n HAVING n > 1
        UNION ALL SELECT page_id, unnest(['later', 'then']), 1 FROM own GROUP BY page_id""",
    "recrawled": f"""WITH {LINES}, {PARAS}
        SELECT doc_id AS page_id, count(*) AS n FROM lines GROUP BY ALL
        UNION ALL SELECT page_id, count(*) FROM paras WHERE page_id NOT IN (SELECT doc_id FROM documents) GROUP BY ALL""",
    "sel_has_chain": f"""WITH {BLOCKS}, own AS (SELECT page_id, n_b > 0 AS bold, row_number() OVER (PARTITION BY page_id ORDER BY i) AS k FROM blocks WHERE tag = 'p')
        SELECT page_id, 'chain' AS rule, 1::BIGINT AS n FROM own WHERE k = 1 AND bold
        UNION ALL SELECT page_id, 'later', 1 FROM own WHERE bold GROUP BY page_id
        UNION ALL SELECT page_id, 'none', CASE WHEN len(hrefs) > 0 THEN 3 ELSE 4 END FROM parts""",
    "sel_lang": f"""WITH {PARAS} SELECT page_id, 'p' AS rule, count(*) AS n FROM paras JOIN parts USING (page_id) WHERE lang = 'en' GROUP BY ALL
        UNION ALL SELECT page_id, 'other', 1 FROM parts WHERE lang NOT IN ('en', 'de')""",
    "sel_nth_of": f"""WITH {BLOCKS}, own AS (SELECT page_id, count(*) AS n, count(*) FILTER (n_b > 0) AS bold FROM blocks WHERE tag = 'p' GROUP BY page_id)
        SELECT page_id, 'second' AS rule, 1::BIGINT AS n FROM own WHERE bold > 1
        UNION ALL SELECT page_id, 'even', n // 2 FROM own WHERE n > 1
        UNION ALL SELECT page_id, 'last', 1 FROM parts WHERE len(hrefs) > 1""",
    "sel_errors": f"""WITH {TAGS}, sums AS (SELECT tag, sum(n) AS n FROM body_tags GROUP BY tag)
        SELECT tag AS rule, n::BIGINT AS n FROM sums UNION ALL SELECT DISTINCT 'bad ' || tag, -1 FROM tags""",
    "sel_states": f"""WITH {LINES} SELECT doc_id AS page_id, unnest(['disabled', 'not_enabled']) AS rule, 1::BIGINT AS n FROM documents""",
    "sel_links": f"WITH {LINKS} SELECT page_id, count(*) AS n FROM links GROUP BY ALL",
    "duplicate_ids": "SELECT page_id, 2::BIGINT AS n FROM pages",
    "attr_map": """SELECT doc_id AS page_id, 'doc-' || doc_id AS id, 2::BIGINT AS n FROM documents""",
    "remove": f"""WITH {BODY_TAGS} SELECT page_id, sum(n)::BIGINT AS n FROM body_tags WHERE tag NOT IN ('nav', 'ul', 'li', 'a') GROUP BY ALL""",
    "written": f"WITH {TAGS} SELECT page_id, sum(n)::BIGINT AS n FROM (SELECT page_id, n FROM tags UNION ALL SELECT page_id, n + 3 FROM texts) GROUP BY ALL",
    "sel_not": f"""WITH {PARAS} SELECT page_id, (len(hrefs) - 1)::BIGINT AS n, 'flat' AS part FROM parts WHERE len(hrefs) > 1
        UNION ALL SELECT page_id, count(*), 'nested' FROM paras WHERE i > 1 GROUP BY ALL""",
    "sel_nth_child": f"""WITH {PARAS}, hits AS (
          SELECT page_id, unnest(['fourth', 'step']) AS rule, unnest([i + 1 = 4, (i + 1 - 2) % 3 = 0]) AS hit FROM paras
          UNION ALL SELECT page_id, unnest(['even', 'upto']), unnest([i % 2 = 0, i <= 3])
          FROM (SELECT page_id, generate_subscripts(hrefs, 1) AS i FROM parts))
        SELECT page_id, rule, count(*) AS n FROM hits WHERE hit GROUP BY ALL""",
    "sel_first_last_child": f"""WITH {LINKS}, paras AS (
          SELECT page_id, list_extract(regexp_extract_all(article, '<p>(?:<b>)?([^<]*)', 1), -1) AS t FROM parts)
        SELECT page_id, 'first' AS rule, {_decoded('anchor')} AS text FROM links WHERE i = 1
        UNION ALL SELECT page_id, 'nth_last', {_decoded('anchor')} FROM links WHERE i = n - 1
        UNION ALL SELECT page_id, 'only', {_decoded('anchor')} FROM links
        UNION ALL SELECT page_id, 'last', {_decoded('t')} FROM paras""",
    "sel_nth_of_type": f"""WITH {PARAS}, hits AS (
          SELECT page_id, unnest(['second', 'last', 'second_last', 'only']) AS rule, unnest([i = 2, i = n, i = n - 1, n = 1]) AS hit FROM paras)
        SELECT page_id, rule, count(*) AS n FROM hits WHERE hit GROUP BY ALL""",
    "sel_empty": f"""WITH {LINES} SELECT doc_id AS page_id, 'p' AS tag, count(*) AS n FROM lines WHERE line = '' GROUP BY ALL
        UNION ALL SELECT doc_id, 'input', 1 FROM documents""",
    "sel_root": _p("SELECT page_id, lang FROM parts"),
    "sel_invalid": "SELECT page_id, url AS tag FROM pages WHERE false",
    "ax_parent": f"""WITH {BLOCKS} SELECT page_id, tag, count(*) AS n FROM blocks WHERE n_b > 0 GROUP BY ALL
        UNION ALL SELECT page_id, 'b', sum(n_b - 1)::BIGINT FROM blocks WHERE n_b > 1 GROUP BY ALL""",
    "ax_first_child": f"WITH {LINKS} SELECT page_id, i::BIGINT AS match_idx, href FROM links",
    "ax_last_child": f"WITH {PARAS} SELECT page_id, text FROM paras WHERE i = n",
    "ax_next": _p(f"SELECT page_id, {_decoded('ad')} AS text FROM parts"),
    "ax_prev": _p("SELECT page_id, comment AS data FROM parts"),
    "ax_children": f"""WITH {PARAS} SELECT page_id, (i + 1)::BIGINT AS match_idx, text FROM paras
        UNION ALL SELECT page_id, 1, {_decoded('h1')} FROM parts""",
    "ax_descendants": f"""WITH {TAGS} SELECT page_id, tag, n::BIGINT AS n FROM body_tags
        UNION ALL SELECT page_id, '', (n - 3 + 1)::BIGINT FROM texts""",
    "ax_ancestors": _p(
        """SELECT page_id, unnest(['a', 'li', 'ul', 'nav', 'body', 'html', '']) AS tag, len(hrefs)::BIGINT AS n FROM parts WHERE len(hrefs) > 0"""
    ),
    "ax_traverse": _p(
        """SELECT page_id, unnest(['li', 'a', '']) AS tag, len(hrefs)::BIGINT AS n FROM parts WHERE len(hrefs) > 0
        UNION ALL SELECT page_id, 'ul', 1 FROM parts"""
    ),
    "ax_iter_children": f"""WITH {LINES} SELECT doc_id AS page_id, 'p' AS tag, count(*) AS n FROM lines GROUP BY ALL
        UNION ALL SELECT doc_id, unnest(['input', 'ul']), 1 FROM documents
        UNION ALL SELECT doc_id, '', count(*) FROM lines WHERE NOT regexp_matches(line, {BLANK}) GROUP BY ALL""",
    "match_counts": f"WITH {BLOCKS} SELECT page_id, sum(n_b)::BIGINT AS n FROM blocks GROUP BY ALL",
    "tag_totals": f"WITH {BODY_TAGS} SELECT tag, page_id, sum(n)::BIGINT AS n FROM body_tags WHERE tag IN ('li', 'p') GROUP BY ROLLUP (tag, page_id)",
    "match_order": f"""WITH {PARAS} SELECT page_id, unnest(range(1, len(hrefs) + 1)) AS match_idx, 'a' AS tag FROM parts
        UNION ALL SELECT page_id, len(hrefs) + 1, 'h1' FROM parts
        UNION ALL SELECT page_id, len(hrefs) + 1 + i, 'p' FROM paras JOIN parts USING (page_id)""",
    "sibling_index": f"""WITH {PARAS}, blocks AS (SELECT * FROM (WITH {BLOCKS} SELECT page_id, ev, n_b FROM blocks)), own AS (
          SELECT page_id, 'p' AS tag, i + 1 AS sib_idx, n + 1 AS sib_n, i + 1 AS el_idx, n - i + 1 AS el_rev, i AS ty_idx, n - i + 1 AS ty_rev FROM paras
          UNION ALL SELECT page_id, 'h1', 1, n + 1, 1, n + 1, 1, 1 FROM paras WHERE i = 1
          UNION ALL SELECT page_id, unnest(['html', 'head', 'body', 'nav', 'div', 'article', 'footer', 'meta', 'title', 'style', 'script', 'ul']),
            unnest([2, 1, 2, 1, 3, 4, 5, 1, 2, 3, 4, 1]), unnest([2, 2, 2, 5, 5, 5, 5, 4, 4, 4, 4, 1]), unnest([1, 1, 2, 1, 2, 3, 4, 1, 2, 3, 4, 1]),
            unnest([1, 2, 1, 4, 3, 2, 1, 4, 3, 2, 1, 1]), 1, 1 FROM parts
          UNION ALL SELECT page_id, 'li', i, n, i, n - i + 1, i, n - i + 1 FROM (SELECT page_id, generate_subscripts(hrefs, 1) AS i, len(hrefs) AS n FROM parts)
          UNION ALL SELECT page_id, 'a', 1, 1, 1, 1, 1, 1 FROM (SELECT page_id, unnest(hrefs) FROM parts)
          UNION ALL SELECT page_id, 'b', 1, 1, 1, 1, 1, 1 FROM (SELECT page_id, unnest(range(n_b)) FROM blocks)
          UNION ALL SELECT page_id, 'br', 2, 2, 1, 1, 1, 1 FROM blocks WHERE ev = '<p><b>')
        SELECT page_id, tag, sib_idx::BIGINT AS sib_idx, sib_n::BIGINT AS sib_n, el_idx::BIGINT AS el_idx, el_rev::BIGINT AS el_rev,
          ty_idx::BIGINT AS ty_idx, ty_rev::BIGINT AS ty_rev FROM own""",
    "coll_nodes": f"WITH {LINKS} SELECT page_id, (i - 1)::BIGINT AS idx, href FROM links",
    "coll_len": f"WITH {BLOCKS} SELECT page_id, sum(n_b)::BIGINT AS len, sum(n_b) = 0 AS is_empty FROM blocks GROUP BY ALL",
    "coll_get": f"WITH {LINKS} SELECT page_id, href FROM links WHERE i = 3",
    "text_own": f"""WITH {LINKS} SELECT page_id, {_decoded('title')} AS text FROM parts
        UNION ALL SELECT page_id, regexp_extract(html, '<style>(.*?)</style>', 1) FROM parts
        UNION ALL SELECT page_id, regexp_extract(html, '<script>(.*?)</script>', 1) FROM parts
        UNION ALL SELECT page_id, {_decoded('unnest([ad, h1, footer])')} FROM parts
        UNION ALL SELECT page_id, {_decoded('anchor')} FROM links
        UNION ALL SELECT page_id, comment FROM parts
        UNION ALL SELECT page_id, {_decoded('t')} FROM (SELECT page_id, unnest(regexp_extract_all(article, '<p>(?:<b>)?([^<]*)', 1)) AS t FROM parts)""",
    "text_deep": _p(f"""SELECT page_id, {_decoded("regexp_replace(article, '<[^>]*>', '', 'g')")} AS text FROM parts"""),
    "text_nested": f"""WITH {LINKS}, whole AS (SELECT page_id, {_decoded("array_to_string(anchors, '')")} AS t FROM parts)
        SELECT page_id, unnest(['nav', 'ul']) AS tag, t AS text FROM whole
        UNION ALL SELECT page_id, 'li', {_decoded('anchor')} FROM links""",
    "text_strip": """SELECT doc_id AS page_id,
          regexp_replace(replace(text, chr(10), chr(10)) || chr(10) || lang || source || n_chars, '^\\s+', '') AS text FROM documents""",
    "text_shallow_parts": """SELECT doc_id AS page_id, unnest([1, 2, 3])::BIGINT AS match_idx, unnest([lang, source, n_chars::VARCHAR]) AS text FROM documents""",
    "text_shallow_blank": """SELECT doc_id AS page_id, chr(10) || ' ' || repeat('|' || chr(10), len(string_split(text, chr(10)))) AS text FROM documents""",
    "text_fragments": f"""WITH {LINES}, kept AS (
          SELECT doc_id, string_agg(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), ' / ' ORDER BY i) AS t
          FROM lines WHERE NOT regexp_matches(line, {BLANK}) GROUP BY doc_id)
        SELECT doc_id AS page_id, concat_ws(' / ', t, lang, source, n_chars) AS text FROM documents LEFT JOIN kept USING (doc_id)""",
    "raw_value": f"""WITH {LINES}, texts AS (SELECT doc_id, line AS t FROM lines WHERE line <> '' UNION ALL SELECT doc_id, chr(10) FROM lines
          UNION ALL SELECT doc_id, unnest([chr(10) || ' ', lang, source, n_chars::VARCHAR]) FROM documents)
        SELECT doc_id AS page_id, hex(encode(t)) AS raw FROM texts""",
    "outer_html": "SELECT page_id, regexp_extract(html, '<nav>.*</nav>') AS html FROM pages",
    "inner_html": "SELECT page_id, regexp_extract(html, '<nav><ul>(.*)</ul></nav>', 1) AS html FROM pages",
    "outer_html_docs": f"""WITH {LINES}, body AS (
          SELECT doc_id, string_agg('<p data-i="' || (i - 1) || '">' || {_escaped('line')} || '</p>' || chr(10), '' ORDER BY i) AS ps FROM lines GROUP BY ALL)
        SELECT doc_id AS page_id, '<div id="doc-' || doc_id || '" class="doc ' || lang || '  ' || source || '">' || chr(10) || ' <!--' || lang || '-->'
          || ps || '<input disabled value="' || n_chars || '"><ul class="meta"><li>' || lang || '<ul><li>' || source || '</li></ul></li><li>'
          || n_chars || '</li></ul></div>' AS html FROM documents JOIN body USING (doc_id)""",
    "pretty_outer": f"""WITH {LINKS}, items AS (SELECT page_id, string_agg('    <li>' || chr(10) || '      <a href="' || href || '">' || chr(10)
          || '        ' || anchor || chr(10) || '      </a>' || chr(10) || '    </li>' || chr(10), '' ORDER BY i) AS t FROM links GROUP BY ALL)
        SELECT page_id, '<nav>' || chr(10) || '  <ul>' || chr(10) || coalesce(t, '') || '  </ul>' || chr(10) || '</nav>' || chr(10) AS html
        FROM parts LEFT JOIN items USING (page_id)""",
    "pretty_inner": f"""WITH {LINKS}, items AS (SELECT page_id, string_agg('    <li>' || chr(10) || '      <a href="' || href || '">' || chr(10)
          || '        ' || anchor || chr(10) || '      </a>' || chr(10) || '    </li>' || chr(10), '' ORDER BY i) AS t FROM links GROUP BY ALL)
        SELECT page_id, coalesce(t, '') AS html FROM parts LEFT JOIN items USING (page_id)""",
    "pretty_flags": f"""WITH {LINES}, body AS (
          SELECT doc_id, string_agg('    <html:p data-i="' || (i - 1) || '">' || chr(10)
            || CASE WHEN regexp_matches(line, {BLANK}) THEN '' ELSE line || chr(10) END, '' ORDER BY i) AS ps FROM lines GROUP BY ALL)
        SELECT doc_id AS page_id, '  <html:div id="doc-' || doc_id || '" class="doc ' || lang || '  ' || source || '">' || chr(10) || ps
          || '    <html:input disabled value="' || n_chars || '">' || chr(10) || '    <html:ul class="meta">' || chr(10) || '      <html:li>' || chr(10)
          || lang || chr(10) || '        <html:ul>' || chr(10) || '          <html:li>' || chr(10) || source || chr(10) || '      <html:li>' || chr(10)
          || n_chars || chr(10) AS html FROM documents JOIN body USING (doc_id)""",
    "doctype_full": """SELECT doc_id AS page_id, unnest([false, true]) AS flag, unnest(['<!DOCTYPE html>' || chr(10),
          '<!DOCTYPE html PUBLIC "-//W3C//DTD HTML 4.01//EN" "http://www.w3.org/TR/html4/strict.dtd">' || chr(10)]) AS html FROM documents""",
    "pretty_escapes": f"""WITH {LINES} SELECT doc_id AS page_id, CASE WHEN line = '' THEN '' ELSE {_escaped('line')} || chr(10) END AS html FROM lines""",
    "decompose": f"""WITH {BODY_TAGS}, kept AS (
          SELECT page_id, tag, n FROM body_tags WHERE tag NOT IN ('p', 'b', 'br')
          UNION ALL SELECT page_id, 'b', n_b FROM blocks WHERE tag = 'footer' AND n_b > 0)
        SELECT page_id, tag, sum(n)::BIGINT AS n FROM kept GROUP BY ALL""",
    "decompose_shallow": """SELECT doc_id AS page_id, unnest([1, 2])::BIGINT AS match_idx, unnest([lang, n_chars::VARCHAR]) AS text FROM documents""",
    "unwrap": _p(
        f"""SELECT page_id, {_reprinted("regexp_replace(article, '<p><b>([^<]*)<br>', '<p>\\1<br></p>', 'g')")} AS html FROM parts"""
    ),
    "unwrap_nested": """SELECT doc_id AS page_id, 2::BIGINT AS n FROM documents""",
    "strip_tags": f"""WITH {TAGS}, kept AS (
          SELECT page_id, tag, n FROM tags WHERE tag NOT IN ('nav', 'ul', 'li', 'a', 'div', 'p', 'b', 'br')
          UNION ALL SELECT page_id, 'b', n_b FROM blocks WHERE tag = 'footer' AND n_b > 0
          UNION ALL SELECT page_id, '', 5 FROM parts)
        SELECT page_id, tag, sum(n)::BIGINT AS n FROM kept GROUP BY ALL""",
    "append_text": f"""WITH {PARAS} SELECT page_id, {_decoded('any_value(h1)')} || string_agg(text || ' [end]', '' ORDER BY i) || ' [end]' AS text
        FROM paras JOIN parts USING (page_id) GROUP BY page_id""",
    "set_attr": """SELECT page_id, regexp_replace(regexp_extract(html, '<nav>.*</nav>'), '(<a href="[^"]*")', '\\1 rel="nofollow"', 'g') AS html FROM pages""",
    "remove_attr": """SELECT page_id, regexp_replace(regexp_extract(html, '<nav><ul>(.*)</ul></nav>', 1), ' href="[^"]*"', '', 'g') AS html FROM pages""",
    "clone_subtree": _p(
        """SELECT page_id, (2 + 3 * len(hrefs))::BIGINT AS n, (1 + 3 * len(hrefs))::BIGINT AS last,
          (CASE WHEN len(hrefs) > 0 THEN 4 ELSE 1 END)::BIGINT AS depth, 1::BIGINT AS roots FROM parts"""
    ),
    "clone_shallow": _p("SELECT page_id, len(hrefs)::BIGINT AS n, 0::BIGINT AS last FROM parts WHERE len(hrefs) > 0"),
    "is_removed": f"""WITH {TAGS}, total AS (
          SELECT page_id, sum(n) AS n FROM (SELECT page_id, n FROM tags UNION ALL SELECT page_id, n + 3 FROM texts) GROUP BY ALL)
        SELECT page_id, (2 + 3 * len(hrefs))::BIGINT AS n_removed, (n - 2 - 3 * len(hrefs))::BIGINT AS n_kept FROM parts JOIN total USING (page_id)""",
    "match_rules": f"""WITH {BLOCKS}, hits AS (
          SELECT page_id, 'links' AS rule, len(hrefs) AS n FROM parts
          UNION ALL SELECT page_id, unnest(['lead', 'ads']), 1 FROM parts
          UNION ALL SELECT page_id, 'paragraphs', 1 FROM blocks WHERE tag = 'p'
          UNION ALL SELECT page_id, 'bold', CASE WHEN tag = 'p' THEN n_b ELSE greatest(n_b - 1, 0) END FROM blocks)
        SELECT page_id, rule, sum(n)::BIGINT AS n FROM hits GROUP BY ALL HAVING sum(n) > 0""",
    "rule_table": f"WITH {LINKS} SELECT page_id, href AS rule, count(*) AS n FROM links GROUP BY ALL",
    "rule_many": _p("""SELECT page_id, 'li' AS tag, least(len(hrefs), 40)::BIGINT AS n FROM parts WHERE len(hrefs) > 0
        UNION ALL SELECT page_id, 'p', 1 FROM parts WHERE contains(article, '<p>')"""),
    "style_rules": r"""SELECT page_id, regexp_extract(css, '^(.*)\{', 1) AS selector, regexp_extract(css, '\{(.*):', 1) AS prop,
          regexp_extract(css, ':(.*)\}', 1) AS value FROM (SELECT page_id, regexp_extract(html, '<style>(.*?)</style>', 1) AS css FROM pages)""",
    "style_nested": """WITH rules AS (
          SELECT doc_id AS page_id, '@media (min-width: ' || n_chars || 'px)' AS media, lang, n_chars, doc_id FROM documents)
        SELECT page_id, 'p.' || lang AS selector, unnest(['color', 'content']) AS prop, unnest(['red', '"};{"']) AS value, media AS condition FROM rules
        UNION ALL SELECT page_id, '#doc-' || doc_id || ', a', 'margin', '0 ' || n_chars || 'px', media || ' @supports (gap: 1px)' FROM rules
        UNION ALL SELECT page_id, '@font-face', 'src', 'url(' || lang || ')', NULL FROM rules
        UNION ALL SELECT page_id, 'h1 > b i, u', 'width', n_chars::VARCHAR, NULL FROM rules""",
    "extract_fields": f"""WITH {PARAS} SELECT page_id, {_decoded('h1')} AS title, hrefs[1] AS first_link, hrefs[3] AS third_link,
          array_to_string(hrefs, ' ') AS links, text AS lead FROM parts JOIN paras USING (page_id) WHERE i = 1""",
    "link_edges": f"WITH {LINKS} SELECT page_id, url, href FROM links",
    "link_hosts": f"WITH {LINKS} SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, href, count(*) AS n FROM links GROUP BY ALL",
    "clean_text": _p(f"""SELECT page_id, {_decoded("regexp_replace(article, '<[^>]*>', '', 'g')")} AS text FROM parts"""),
    "stream_extract": f"WITH {LINKS} SELECT page_id, href FROM links",
    "sql_nodes": f"WITH {BODY_TAGS} SELECT page_id, tag, n::BIGINT AS n FROM body_tags",
    "sql_view": _p("SELECT page_id, len(hrefs)::BIGINT AS n, len(hrefs)::BIGINT AS last_item FROM parts WHERE len(hrefs) > 0"),
}
ORACLES["index_split"] = ORACLES["sibling_index"]
ORACLES["sel_split"] = f"""WITH {BLOCKS}, own AS (SELECT page_id, count(*) AS n, sum(n_b) AS bold FROM blocks WHERE tag = 'p' GROUP BY page_id)
    SELECT page_id, 'desc' AS rule, bold::BIGINT AS n FROM own WHERE bold > 0 UNION ALL SELECT page_id, 'next', 1 FROM own
    UNION ALL SELECT page_id, 'later', n - 1 FROM own WHERE n > 1"""
