"""One page of HTML text -> its tree, as parallel column lists.

This is the per-row helper behind :mod:`domloom.sources.shred`; it is the only
place where a page is looked at outside Spark expressions.  It follows the HTML
standard's tree construction for ordinary pages: implied ``html``/``head``/``body``,
void and raw-text elements, implied end tags, active formatting elements with
reconstruction, and the adoption agency for misnested formatting.  Foster
parenting, ``template`` contents, framesets, quirks mode and scripting are
outside the contract (see README).
"""

from __future__ import annotations

import html as _html
import re
from html.entities import html5 as _NAMED

# Fixed values of the HTML standard -------------------------------------------
WS = " \t\n\f\r"
VOID = frozenset(
    "area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split()
)
RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("title textarea".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title noscript script style template noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
BLOCK_END = frozenset(
    "address article aside blockquote button center details dialog dir div dl fieldset figcaption figure footer form "
    "header hgroup listing main menu nav ol pre search section summary ul".split()
)
MARKER_TAGS = frozenset("applet marquee object".split())
NO_RECONSTRUCT = CLOSES_P | frozenset("li dd dt rb rtc rp rt param source track".split())
IMPLIED_END = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SCOPE = frozenset("applet caption html table td th marquee object template".split())
SPECIAL = frozenset(
    "address applet area article aside base basefont bgsound blockquote body br button caption center col colgroup dd "
    "details dir div dl dt embed fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html iframe img input keygen li link listing main marquee menu meta nav noembed noframes noscript object "
    "ol p param plaintext pre script search section select source style summary table tbody td template textarea tfoot "
    "th thead title tr track ul wbr xmp".split()
)
TABLE_PART = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
ROW_GROUP = frozenset("tbody thead tfoot".split())
FOREIGN = {"svg": "svg", "math": "math"}
INTEGRATION = frozenset("foreignobject desc title mi mo mn ms mtext".split())
# -----------------------------------------------------------------------------

_MARKUP = re.compile(r"<(?=[A-Za-z/!?])")
_NAME = re.compile(r"[A-Za-z][^ \t\n\f\r/>]*")
_ATTR = re.compile(
    r"[ \t\n\f\r/]*(?:(>)|([^ \t\n\f\r/>][^ \t\n\f\r/>=]*)"
    r"(?:[ \t\n\f\r]*(=)[ \t\n\f\r]*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|(?=>)|([^ \t\n\f\r>]+)|\Z))?)"
)
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[ \t\n\f\r/>])", re.I) for t in RAW_TEXT | RCDATA}
_ATTR_REF = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|([A-Za-z][A-Za-z0-9]*)(;?)(=?))")
_DOCTYPE = re.compile(r"[ \t\n\f\r]*([^ \t\n\f\r>]*)[ \t\n\f\r]*([^>]*)")


def _attr_ref(m):
    name, semi, eq = m.group(1), m.group(2), m.group(3)
    if name and not semi and (eq or name not in _NAMED):
        return m.group(0)
    return _html.unescape(m.group(0))


def _read_attrs(s, pos):
    """Attributes from ``pos``: (list or None at end of input, self_closing, next position)."""
    attrs, seen = [], set()
    while True:
        m = _ATTR.match(s, pos)
        if m is None:
            return None, False, len(s)
        pos = m.end()
        if m.group(1):
            return attrs, m.group(0).endswith("/>"), pos
        name = m.group(2).lower().replace("\0", "�")
        value = None
        if m.group(3):
            value = m.group(4) or m.group(5) or m.group(6) or ""
            if "&" in value:
                value = _ATTR_REF.sub(_attr_ref, value)
        if name not in seen:
            seen.add(name)
            attrs.append((name, value))


def _tokens(s, tree):
    """Yield ``(type, value, attrs, self_closing)``; type is one of ``t s e c d``."""
    pos, n = 0, len(s)
    while pos < n:
        m = _MARKUP.search(s, pos)
        lt = m.start() if m else n
        if lt > pos:
            yield "t", _html.unescape(s[pos:lt]), None, False
        if m is None:
            return
        nxt = s[lt + 1]
        if nxt == "!":
            pos = yield from _declaration(s, lt, n, tree)
            continue
        end_tag = nxt == "/"
        name = _NAME.match(s, lt + 1 + end_tag)
        if name is None:
            if lt + 2 >= n:
                yield "t", s[lt:], None, False
                return
            stop = s.find(">", lt + 1)
            stop = n if stop < 0 else stop
            if not (end_tag and stop == lt + 2):
                yield "c", s[lt + 1 + end_tag : stop], None, False
            pos = stop + 1
            continue
        tag, pos = name.group().lower(), name.end()
        if pos < n and s[pos] == ">":
            attrs, closed, pos = [], False, pos + 1
        else:
            attrs, closed, pos = _read_attrs(s, pos)
            if attrs is None:
                return
        yield ("e" if end_tag else "s"), tag, attrs, closed
        if end_tag or tree.in_foreign():
            continue
        if tag in _RAW_END:
            m = _RAW_END[tag].search(s, pos)
            stop = m.start() if m else n
            raw = s[pos:stop]
            pos = stop
            if tag == "textarea" and raw.startswith("\n"):
                raw = raw[1:]
            if raw:
                yield "t", (_html.unescape(raw) if tag in RCDATA else raw), None, True
        elif tag == "plaintext":
            yield "t", s[pos:], None, True
            return
        elif tag in ("pre", "listing") and s.startswith("\n", pos):
            pos += 1


def _declaration(s, lt, n, tree):
    if s.startswith("<!--", lt):
        if s.startswith(">", lt + 4) or s.startswith("->", lt + 4):
            yield "c", "", None, False
            return s.index(">", lt + 4) + 1
        m = _COMMENT_END.search(s, lt + 4)
        yield "c", s[lt + 4 : m.start() if m else n], None, False
        return m.end() if m else n
    if s.startswith("<![CDATA[", lt) and tree.in_foreign():
        stop = s.find("]]>", lt)
        yield "t", s[lt + 9 : n if stop < 0 else stop], None, True
        return n if stop < 0 else stop + 3
    stop = s.find(">", lt)
    stop = n if stop < 0 else stop
    if s[lt + 2 : lt + 9].lower() == "doctype":
        m = _DOCTYPE.match(s, lt + 9)
        yield "d", m.group(1).lower(), m.group(2).strip(WS), False
    else:
        yield "c", s[lt + 2 : stop], None, False
    return stop + 1


class PageTree:
    """Tree of one page; node 0 is the document."""

    def __init__(self, text):
        self.kind, self.tag, self.ns = [9], [""], [""]
        self.attrs, self.data, self.up, self.kids = [None], [None], [-1], [[]]
        self.open, self.n_open, self.fmt = [], {}, []
        self.root = self.head = self.body = self.form = None
        self.phase = "start"
        handle = {"t": self._text, "s": self._start, "e": self._end, "c": self._comment, "d": self._doctype}
        if "\r" in text:
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        for kind, value, attrs, flag in _tokens(text, self):
            handle[kind](value, attrs, flag)
        self._need_body()

    # -- nodes and the stack of open elements
    def _new(self, parent, kind, tag="", attrs=None, data=None, ns=""):
        i = len(self.kind)
        self.kind.append(kind)
        self.tag.append(tag)
        self.ns.append(ns)
        self.attrs.append(attrs)
        self.data.append(data)
        self.up.append(parent)
        self.kids.append([])
        self.kids[parent].append(i)
        return i

    def _push(self, i):
        self.open.append(i)
        self.n_open[self.tag[i]] = self.n_open.get(self.tag[i], 0) + 1
        return i

    def _pop(self, at=-1):
        i = self.open.pop(at)
        self.n_open[self.tag[i]] -= 1
        return i

    def _pop_to(self, names):
        while self.tag[self._pop()] not in names:
            pass

    def _insert(self, tag, attrs, ns="html", void=False):
        i = self._new(self.open[-1], 1, tag, attrs, ns=ns)
        return i if void else self._push(i)

    def in_foreign(self):
        return bool(self.open) and self.ns[self.open[-1]] != "html" and self.tag[self.open[-1]] not in INTEGRATION

    def _is_open(self, names, stops=()):
        """A tag of ``names`` is open below the nearest scope boundary."""
        if not any(self.n_open.get(t) for t in names):
            return False
        for i in reversed(self.open):
            t = self.tag[i]
            if t in names:
                return True
            if t in SCOPE or t in stops:
                return False
        return False

    def _implied(self, keep=()):
        while self.tag[self.open[-1]] in IMPLIED_END and self.tag[self.open[-1]] not in keep:
            self._pop()

    def _close_p(self):
        if self._is_open(("p",), ("button",)):
            self._implied(("p",))
            self._pop_to(("p",))

    # -- html, head and body
    def _need_root(self, attrs=()):
        if self.root is None:
            self.root = self._push(self._new(0, 1, "html", list(attrs), ns="html"))
            self.phase = "before head"

    def _need_head(self, attrs=()):
        self._need_root()
        if self.head is None:
            self.head = self._insert("head", list(attrs))
            self.phase = "head"

    def _leave_head(self):
        self._need_head()
        if self.phase == "head":
            while len(self.open) > 1:
                self._pop()
            self.phase = "after head"

    def _need_body(self, attrs=()):
        self._leave_head()
        if self.body is None:
            self.body = self._insert("body", list(attrs))
        self.phase = "body"

    def _merge_attrs(self, i, attrs):
        have = {a for a, _ in self.attrs[i]}
        self.attrs[i].extend(a for a in attrs if a[0] not in have)

    # -- formatting elements
    def _reconstruct(self):
        fmt = self.fmt
        if not fmt or fmt[-1] is None or fmt[-1] in self.open:
            return
        live = set(self.open)
        k = len(fmt)
        while k and fmt[k - 1] is not None and fmt[k - 1] not in live:
            k -= 1
        for j in range(k, len(fmt)):
            old = fmt[j]
            fmt[j] = self._insert(self.tag[old], self.attrs[old])

    def _push_fmt(self, i):
        same = []
        for j in reversed(self.fmt):
            if j is None:
                break
            if self.tag[j] == self.tag[i] and sorted(self.attrs[j], key=str) == sorted(self.attrs[i], key=str):
                same.append(j)
        if len(same) >= 3:
            self.fmt.remove(same[-1])
        self.fmt.append(i)

    def _find_fmt(self, tag):
        for j in reversed(self.fmt):
            if j is None:
                return None
            if self.tag[j] == tag:
                return j
        return None

    def _clear_fmt(self):
        while self.fmt and self.fmt.pop() is not None:
            pass

    def _move(self, i, parent):
        self.kids[self.up[i]].remove(i)
        self.kids[parent].append(i)
        self.up[i] = parent

    def _adopt(self, tag):
        """Adoption agency: close a formatting element that may be misnested."""
        if self.tag[self.open[-1]] == tag and self.open[-1] not in self.fmt:
            self._pop()
            return
        for _ in range(8):
            fe = self._find_fmt(tag)
            if fe is None:
                self._end_other(tag)
                return
            if fe not in self.open:
                self.fmt.remove(fe)
                return
            if not self._is_open((tag,)):
                return
            at = self.open.index(fe)
            inner = next((i for i in self.open[at + 1 :] if self.tag[i] in SPECIAL), None)
            if inner is None:
                while self._pop() != fe:
                    pass
                self.fmt.remove(fe)
                return
            common, last, mark, step = self.open[at - 1], inner, self.fmt.index(fe), 0
            for node in reversed(self.open[at + 1 : self.open.index(inner)]):
                step += 1
                if node in self.fmt and step > 3:
                    mark -= self.fmt.index(node) < mark
                    self.fmt.remove(node)
                if node not in self.fmt:
                    self._pop(self.open.index(node))
                    continue
                copy = self._new(common, 1, self.tag[node], self.attrs[node], ns="html")
                self.fmt[self.fmt.index(node)] = copy
                self.open[self.open.index(node)] = copy
                if last == inner:
                    mark = self.fmt.index(copy) + 1
                self._move(last, copy)
                last = copy
            self._move(last, common)
            copy = self._new(inner, 1, tag, self.attrs[fe], ns="html")
            self.kids[inner].pop()
            for child in self.kids[inner]:
                self.up[child] = copy
            self.kids[copy], self.kids[inner] = self.kids[inner], [copy]
            mark -= self.fmt.index(fe) < mark
            self.fmt.remove(fe)
            self.fmt.insert(mark, copy)
            self.open[self.open.index(fe) :] = [i for i in self.open[self.open.index(fe) :] if i != fe]
            self.open.insert(self.open.index(inner) + 1, copy)

    # -- token handlers
    def _doctype(self, name, ids, _flag):
        if self.phase == "start":
            self._new(0, 10, data=f"{name} {ids}".strip())

    def _comment(self, data, _attrs, _flag):
        parent = {"start": 0, "after body": self.root, "after html": 0}.get(self.phase)
        self._new(self.open[-1] if parent is None else parent, 8, data=data.replace("\0", "�"))

    def _text(self, data, _attrs, verbatim):
        data = data.replace("\0", "")
        if not verbatim and self.phase not in ("body", "after body", "after html"):
            rest = data.lstrip(WS)
            lead = data[: len(data) - len(rest)]
            if lead and self.phase in ("head", "after head"):
                self._append_text(lead)
            data = rest
            if data:
                self._need_body()
        elif not verbatim and self.phase in ("after body", "after html") and data.strip(WS):
            self.phase = "body"
        if data:
            if not verbatim and not self.in_foreign():
                self._reconstruct()
            self._append_text(data)

    def _append_text(self, data):
        parent = self.open[-1]
        kids = self.kids[parent]
        if kids and self.kind[kids[-1]] == 3:
            self.data[kids[-1]] += data
        else:
            self._new(parent, 3, data=data)

    def _start(self, tag, attrs, closed):
        if tag == "html":
            self._need_root()
            self._merge_attrs(self.root, attrs)
            return
        self._need_root()
        if tag == "head":
            if self.head is None:
                self._need_head(attrs)
            return
        if tag == "body":
            if self.body is None:
                self._need_body(attrs)
            else:
                self._merge_attrs(self.body, attrs)
            return
        if tag in ("frameset", "frame"):
            return
        if self.phase != "body":
            if tag in HEAD_ONLY and self.body is None:
                self._need_head()
                if self.phase == "after head":
                    self._in_late_head(tag, attrs)
                else:
                    self._insert(tag, attrs, void=tag in VOID)
                return
            self._need_body()
        if self.in_foreign():
            self._start_foreign(tag, attrs, closed)
        elif tag in TABLE_PART:
            self._start_table_part(tag, attrs)
        else:
            self._start_in_body("img" if tag == "image" else tag, attrs, closed)

    def _in_late_head(self, tag, attrs):
        i = self._new(self.head, 1, tag, attrs, ns="html")
        if tag not in VOID:
            self._push(i)

    def _start_foreign(self, tag, attrs, closed):
        if tag in CLOSES_P - {"form", "search"} or tag in FORMATTING - {"a"} or tag in ("img", "br", "li", "dd", "dt"):
            while self.ns[self.open[-1]] != "html" and self.tag[self.open[-1]] not in INTEGRATION:
                self._pop()
            self._start(tag, attrs, closed)
        else:
            self._insert(tag, attrs, self.ns[self.open[-1]], void=closed)

    def _start_in_body(self, tag, attrs, closed):
        if tag in CLOSES_P:
            if tag == "form" and self.form is not None:
                return
            self._close_p()
            if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
                self._pop()
        elif tag in ("li", "dd", "dt"):
            self._close_item(("li",) if tag == "li" else ("dd", "dt"))
            self._close_p()
        elif tag in ("option", "optgroup"):
            if self.tag[self.open[-1]] == "option":
                self._pop()
        elif tag in ("rb", "rtc", "rp", "rt"):
            if self._is_open(("ruby",)):
                self._implied(("rtc",) if tag in ("rp", "rt") else ())
        elif tag == "button" and self._is_open(("button",)):
            self._implied()
            self._pop_to(("button",))
        elif tag == "a" and self._find_fmt("a") is not None:
            stale = self._find_fmt("a")
            self._adopt("a")
            if stale in self.fmt:
                self.fmt.remove(stale)
            if stale in self.open:
                self._pop(self.open.index(stale))
        if tag not in NO_RECONSTRUCT and tag not in HEAD_ONLY or tag == "xmp":
            self._reconstruct()
        if tag == "nobr" and self._is_open(("nobr",)):
            self._adopt("nobr")
            self._reconstruct()
        foreign = FOREIGN.get(tag)
        i = self._insert(tag, attrs, foreign or "html", void=tag in VOID or bool(foreign and closed))
        if tag in FORMATTING:
            self._push_fmt(i)
        elif tag in MARKER_TAGS:
            self.fmt.append(None)
        elif tag == "form":
            self.form = i

    def _close_item(self, names):
        if not any(self.n_open.get(t) for t in names):
            return
        for i in reversed(self.open):
            t = self.tag[i]
            if t in names:
                self._implied((t,))
                self._pop_to((t,))
                return
            if t in SPECIAL and t not in ("address", "div", "p"):
                return

    def _start_table_part(self, tag, attrs):
        if not self.n_open.get("table"):
            return
        if tag in ("td", "th"):
            wanted, missing = {"tr"}, ("tbody", "tr")
        elif tag == "tr":
            wanted, missing = ROW_GROUP, ("tbody",)
        elif tag == "col":
            wanted, missing = {"colgroup"}, ("colgroup",)
        else:
            wanted, missing = {"table"}, ()
        while self.tag[self.open[-1]] not in wanted | {"table"} and not (wanted == {"tr"} and self.tag[self.open[-1]] in ROW_GROUP):
            self._pop_cell()
        if self.tag[self.open[-1]] not in wanted:
            for t in missing[self.tag[self.open[-1]] in ROW_GROUP :]:
                self._insert(t, [])
        self._insert(tag, attrs, void=tag == "col")
        if tag in ("td", "th", "caption"):
            self.fmt.append(None)

    def _pop_cell(self):
        if self.tag[self._pop()] in ("td", "th", "caption"):
            self._clear_fmt()

    def _end(self, tag, _attrs, _flag):
        if self.phase == "start" and tag not in ("html", "head", "body", "br"):
            return
        self._need_root()
        if tag in ("body", "html"):
            if self.phase != "after html":
                self._need_body()
                self.phase = f"after {tag}"
            return
        if tag == "head":
            if self.body is None:
                self._leave_head()
            return
        if self.phase in ("head", "after head") and len(self.open) > 1 and self.tag[self.open[-1]] == tag:
            self._pop()
            return
        if self.phase in ("before head", "head", "after head"):
            if tag != "br":
                return
            self._need_body()
        self.phase = "body"
        if tag == "br":
            self._start("br", [], False)
        elif tag in FORMATTING and not self.in_foreign():
            self._adopt(tag)
        elif tag == "p":
            if not self._is_open(("p",), ("button",)):
                self._insert("p", [])
            self._close_p()
        elif tag in HEADINGS:
            if self._is_open(HEADINGS):
                self._implied()
                self._pop_to(HEADINGS)
        elif tag in ("li", "dd", "dt") or tag in BLOCK_END or tag in MARKER_TAGS:
            if tag == "form":
                self.form = None
            if self._is_open((tag,), ("ol", "ul") if tag == "li" else ()):
                self._implied((tag,))
                self._pop_to((tag,))
                if tag in MARKER_TAGS:
                    self._clear_fmt()
        elif tag == "table" or tag in TABLE_PART:
            self._end_table_part(tag)
        else:
            self._end_other(tag)

    def _end_table_part(self, tag):
        tables_above = [t for t in map(self.tag.__getitem__, reversed(self.open))]
        if tag in tables_above and ("table" not in tables_above or tables_above.index(tag) <= tables_above.index("table")):
            while self.tag[self.open[-1]] != tag:
                self._pop_cell()
            self._pop_cell()

    def _end_other(self, tag):
        if not self.n_open.get(tag):
            return
        for i in reversed(self.open):
            if self.tag[i] == tag:
                self._implied((tag,))
                while self._pop() != i:
                    pass
                return
            if self.tag[i] in SPECIAL and self.ns[i] == "html":
                return

    # -- result
    def emit(self, page_id, out):
        """Append the page's nodes, in document order, to the column lists of ``out``; return their number."""
        up, kids = self.up, self.kids
        order, stack = [], [0]
        while stack:
            i = stack.pop()
            order.append(i)
            stack.extend(reversed(kids[i]))
        n = len(order)
        pre, last = [0] * len(up), [0] * len(up)
        for p, i in enumerate(order):
            pre[i] = p
        for i in reversed(order):
            last[i] = last[kids[i][-1]] if kids[i] else pre[i]
        depth = [0] * len(up)
        for i in order[1:]:
            depth[i] = depth[up[i]] + 1
        head, body = pre[self.head], pre[self.body]
        head_last, body_last = last[self.head], last[self.body]
        out["page_id"].extend([page_id] * n)
        out["node_id"].extend(range(n))
        out["pre"].extend(range(n))
        out["last"].extend(last[i] for i in order)
        out["parent"].extend(pre[up[i]] if i else None for i in order)
        out["depth"].extend(depth[i] for i in order)
        for name in ("kind", "tag", "ns", "data"):
            column = getattr(self, name)
            out[name].extend(column[i] for i in order)
        out["attrs"].extend(self.attrs[i] or () for i in order)
        out["in_head"].extend(head < p <= head_last for p in range(n))
        out["in_body"].extend(body < p <= body_last for p in range(n))
        return n
