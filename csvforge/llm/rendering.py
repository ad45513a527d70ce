"""Operator 6: layout-aware rendering of web pages to text.

Each page is tokenized, built into a tree (with implied end tags, void elements and
raw text), and laid out: blocks on lines of their own, paragraphs apart, lists with
markers and indentation, table cells aligned in columns, preformatted text as it
is.  Everything a reader would see is emitted; heads, scripts, comments, hidden
elements (``hidden``, ``display:none``, ``visibility:hidden`` unless made visible
again, closed ``details``, hidden inputs) are not.  Formulas (MathML without annotations) and
the text elements of drawings (SVG without titles, descriptions and definitions) are
laid out in line.  ``object``, ``canvas``, ``audio`` and ``video`` are taken as shown,
so the text inside them, meant for readers who cannot see them, is left out.

One narrow Arrow pass over the pages.  Null or empty html gives an empty text.
Repeated rows and null ids are kept one for one.  Elements nested deeper than
``DEPTH`` are hung up at that depth (no text is lost).
"""
from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table
from .textnum import slices

DEPTH = 200

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/](?![a-zA-Z])[^>]*+(?:>|\Z)|<![^>]*+(?:>|\Z)
    |</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.S)
_ENDED = re.compile(r"""(?<!=)(?:^|[\s"'])(?:[^\s"'=]*)/\Z""")
FOREIGN = frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes datalist object "
                   "canvas audio video annotation annotation-xml link meta base param source track area col colgroup".split())
# of a drawing, what holds text and what only holds that; its other text is not painted
DRAWN = frozenset("text tspan textpath foreignobject".split())
DRAWN_IN = frozenset("svg g a switch".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu fieldset".split())
BLOCK = APART | frozenset("address article aside body center dd details dialog dir div dt fieldset figcaption footer form "
                          "header hgroup html legend li main nav option optgroup section summary tr td th thead tbody "
                          "tfoot caption".split())
ENDS_P = BLOCK - frozenset("body html tr td th thead tbody tfoot caption option optgroup legend summary".split())
# start tag -> open elements it ends, and the elements beyond which it does not look
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "caption": ({"caption"}, {"table"}),
    **{t: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, set()),
}
SCOPE = frozenset("table td th caption button object template html".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag, attrs=None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def tree(html: str) -> Node:
    """The element tree of a page; strings are text."""
    root = Node("#root")
    stack, at, n = [root], 0, len(html)
    pre_skip = False

    def close(tags, stops):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return True
            if stack[i].tag in stops:
                return False
        return False

    def text(t):
        nonlocal pre_skip
        if t:
            if pre_skip and t[0] == "\n":
                t = t[1:]
            if stack[-1].tag == "head" and t.strip():
                stack.pop()
            stack[-1].kids.append(unescape(t) if "&" in t else t)
        pre_skip = False

    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        end, tag = m.group(1), m.group(2)
        if end:
            end = end.lower()
            if end in ("p", "br"):
                if end == "br" or not close({"p"}, SCOPE):
                    stack[-1].kids.append(Node(end))
            elif end not in VOID:
                close({end}, {"table"} if end not in ("table", "body", "html") else set())
        elif tag:
            tag = tag.lower()
            attrs = {}
            for a in ATTR.finditer(m.group(3)):
                attrs.setdefault(a.group(1).lower(), unescape(a.group(2) or a.group(3) or a.group(4) or ""))
            if tag in ("html", "body") and any(x.tag == tag for x in stack):
                continue
            if stack[-1].tag == "head" and tag not in UNSEEN:
                stack.pop()
            if tag in ENDS_P:
                close({"p"}, SCOPE)
            if tag in IMPLIED:
                ends, stops = IMPLIED[tag]
                while close(ends, stops):
                    pass
            node = Node(tag, attrs)
            stack[min(len(stack), DEPTH) - 1].kids.append(node)
            if m.group(3)[-1:] == "/" and _ENDED.search(m.group(3)) and (tag in FOREIGN or any(x.tag in FOREIGN for x in stack)):
                pass                                   # only there does "/>" end an element
            elif tag in RAW:
                e = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(html, at)
                body = html[at:e.start()] if e else html[at:]
                node.kids.append(unescape(body) if tag in ("title", "textarea") else body)
                at = e.end() if e else n
            elif tag not in VOID:
                stack.append(node)
            pre_skip = tag == "pre"
    return root


_HIDE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VIS = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)
_WS = re.compile(r"[ \t\n\r\f]+")


class Lines:
    """Collects laid-out lines; blocks ask for breaks, inline text fills them."""

    def __init__(self):
        self.lines, self.cur, self.gap, self.space = [], "", 0, False

    def text(self, t: str, pre: bool):
        if pre:
            for i, part in enumerate(t.split("\n")):
                if i:
                    self.newline()
                if part:
                    self._put(part)
            return
        words = _WS.split(t)
        if words[0] == "" and len(words) > 1:
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self._put((" " if self.space and self.cur else "") + body)
            self.space = False
        if words[-1] == "" and len(words) > 1:
            self.space = True

    def _put(self, t: str):
        if not self.cur and self.gap and self.lines:
            self.lines += [""] * (self.gap - 1)
        self.gap = 0
        self.cur += t

    def newline(self):
        self.lines.append(self.cur)
        self.cur, self.space = "", False

    def block(self, apart: bool):
        if self.cur:
            self.lines.append(self.cur)
            self.cur = ""
        self.space = False
        self.gap = max(self.gap, 2 if apart else 1)

    def add(self, lines: list[str], apart: bool):
        if not lines:
            return
        self.block(apart)
        for i, x in enumerate(lines):
            if i == 0 and self.gap and self.lines:
                self.lines += [""] * (self.gap - 1)
            self.lines.append(x)
        self.gap = 2 if apart else 1

    def done(self) -> list[str]:
        if self.cur:
            self.lines.append(self.cur)
            self.cur = ""
        out = [x.rstrip() for x in self.lines]
        while out and not out[0]:
            out.pop(0)
        while out and not out[-1]:
            out.pop()
        return out


def _shown(node: Node, visible: bool):
    """(laid out at all, own text visible)."""
    if node.tag in UNSEEN or "hidden" in node.attrs:
        return False, visible
    if node.tag == "input" and node.attrs.get("type", "").lower() in ("hidden", "checkbox", "radio", "password", "file"):
        return False, visible
    style = node.attrs.get("style")
    if style:
        if _HIDE.search(style):
            return False, visible
        v = _VIS.search(style)
        if v:
            visible = v.group(1).lower() not in ("hidden", "collapse")
    return True, visible


def _drawing(node: Node, out: Lines, pre: bool, visible: bool):
    """The text elements of a drawing, in line."""
    for kid in node.kids:
        if isinstance(kid, str):
            continue
        ok, vis = _shown(kid, visible)
        if not ok or kid.attrs.get("display") == "none":
            continue
        if kid.tag in DRAWN:
            out.text(" ", pre)
            _fill(kid, out, pre, vis)
            out.text(" ", pre)
        elif kid.tag in DRAWN_IN:
            _drawing(kid, out, pre, vis)


def _fill(node: Node, out: Lines, pre: bool, visible: bool):
    for kid in node.kids:
        if isinstance(kid, str):
            if visible:
                out.text(kid, pre)
            continue
        tag = kid.tag
        ok, vis = _shown(kid, visible)
        if not ok:
            continue
        if tag == "br":
            out.newline()
        elif tag == "wbr":
            pass
        elif tag == "input":
            if vis and kid.attrs.get("value"):
                out.text(f" {kid.attrs['value']} ", False)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.add(_list(kid, pre, vis), node.tag != "li")
        elif tag == "table":
            out.add(_table(kid, pre, vis), True)
        elif tag in ("blockquote", "dd"):
            out.add(["  " + x if x else x for x in _lines(kid, pre, vis)], tag == "blockquote")
        elif tag == "details" and "open" not in kid.attrs:
            first = next((k for k in kid.kids if isinstance(k, Node) and k.tag == "summary"), None)
            if first is not None and _shown(first, vis)[0]:
                out.add(_lines(first, pre, vis), False)
        elif tag == "select":
            _select(kid, out, vis)
        elif tag == "svg":
            _drawing(kid, out, pre, vis)
        elif tag == "q":
            out.text("“", pre)
            _fill(kid, out, pre, vis)
            out.text("”", pre)
        elif tag in BLOCK:
            out.block(tag in APART)
            _fill(kid, out, pre or tag == "pre", vis)
            out.block(tag in APART)
        else:
            _fill(kid, out, pre or tag in ("textarea", "xmp"), vis)


def _lines(node: Node, pre: bool, visible: bool) -> list[str]:
    out = Lines()
    _fill(node, out, pre, visible)
    return out.done()


def _select(node: Node, out: Lines, visible: bool):
    """The options a closed list box shows: those selected, or the first."""
    options, todo = [], [node]
    while todo:
        for k in reversed(todo.pop().kids):
            if isinstance(k, Node):
                (options if k.tag == "option" else todo).append(k)
    options = options[::-1]
    chosen = [o for o in options if "selected" in o.attrs] or options[:1]
    if "multiple" in node.attrs:
        chosen = options
    for o in chosen:
        if visible:
            out.text(" " + " ".join(_lines(o, False, visible)) + " ", False)


def _number(value, default: int) -> int:
    try:
        return int(value)
    except (TypeError, ValueError):
        return default


def _list(node: Node, pre: bool, visible: bool) -> list[str]:
    out, k = [], _number(node.attrs.get("start"), 1)
    for kid in node.kids:
        if isinstance(kid, str):
            if visible and kid.strip():
                out.append(" ".join(kid.split()))
            continue
        ok, vis = _shown(kid, visible)
        if not ok:
            continue
        if kid.tag in ("ul", "ol", "menu", "dir"):
            out += ["  " + x for x in _list(kid, pre, vis)]
            continue
        mark = ""
        if kid.tag == "li":
            k = _number(kid.attrs.get("value"), k)
            mark = f"{k}. " if node.tag == "ol" else "- "
            k += 1
        holder = Node("li")
        holder.kids = kid.kids if kid.tag == "li" else [kid]
        body = _lines(holder, pre, vis)
        if body:
            out += [mark + body[0]] + [(" " * len(mark) + x) if x else x for x in body[1:]]
    return out


def _table(node: Node, pre: bool, visible: bool) -> list[str]:
    caption, rows, loose = [], [], []

    def walk(n, vis):
        for k in n.kids:
            if isinstance(k, str):
                if vis and k.strip():
                    loose.append(" ".join(k.split()))
                continue
            ok, v = _shown(k, vis)
            if not ok:
                continue
            if k.tag == "tr":
                rows.append((k, v))
            elif k.tag in ("thead", "tbody", "tfoot"):
                walk(k, v)
            elif k.tag == "caption":
                caption.extend(_lines(k, pre, v))
            elif k.tag in ("td", "th"):
                row = Node("tr")
                row.kids = [k]
                rows.append((row, v))
            else:
                holder = Node("div")
                holder.kids = [k]
                loose.extend(_lines(holder, pre, v))

    walk(node, visible)
    grid, busy = [], {}                               # busy: column -> rows still covered from above
    for tr, vis in rows:
        cells, col = [], 0
        down = {c: r - 1 for c, r in busy.items() if r > 1}
        for td in tr.kids:
            if isinstance(td, str):
                if vis and td.strip():
                    loose.append(" ".join(td.split()))
                continue
            ok, v = _shown(td, vis)
            if not ok:
                continue
            while col in busy:
                col += 1
            holder = td
            if td.tag not in ("td", "th"):
                holder = Node("td")
                holder.kids = [td]
            wide = min(max(1, _number(td.attrs.get("colspan"), 1)), 1000)
            tall = min(max(1, _number(td.attrs.get("rowspan"), 1)), 65534)
            cells.append((col, wide, _lines(holder, pre, v)))
            for c in range(col, col + wide):
                if tall > 1:
                    down[c] = tall - 1
            col += wide
        busy = down
        if any(body for _, _, body in cells):
            grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for col, wide, body in cells:
            if wide == 1:
                width[col] = max(width.get(col, 0), max(map(len, body), default=0))
    out = list(loose) + caption
    starts, x = {}, 0
    for c in range(max((c + w for r in grid for c, w, _ in r), default=0)):
        starts[c] = x
        if c in width:
            x += width[c] + 2
    for cells in grid:
        for i in range(max(len(body) for _, _, body in cells)):
            line = ""
            for col, _, body in cells:
                part = body[i] if i < len(body) else ""
                if part:
                    if line:
                        line = line.ljust(max(starts[col], len(line) + 2))
                    else:
                        line = " " * starts[col]
                    line += part
            out.append(line.rstrip())
    return out


def _title(node: Node) -> str:
    todo = [node]
    while todo:
        n = todo.pop()
        if n.tag == "title":
            return " ".join("".join(k for k in n.kids if isinstance(k, str)).split())
        todo += [k for k in reversed(n.kids) if isinstance(k, Node) and k.tag not in ("svg", "template")]
    return ""


def render(html: str | None) -> tuple[str, str]:
    """(title, visible text) of a page."""
    root = tree((html or "").replace("\r\n", "\n").replace("\r", "\n"))
    return _title(root), "\n".join(_lines(root, False, True))


def render_pages(df: DataFrame, html: str = "html", columns=("page_id", "url")) -> DataFrame:
    """``columns`` of every page with ``title``, ``text``, ``n_chars`` and ``n_lines``."""
    prepare(df.sparkSession)
    keep = [c for c in columns if c.lower() not in ("title", "text", "n_chars", "n_lines")]
    src = df.select(*keep, F.col(html).alias("__html"))
    schema = src.select(*keep).schema
    for name, kind in (("title", "string"), ("text", "string"), ("n_chars", "long"), ("n_lines", "long")):
        schema = schema.add(name, kind)

    def run(it):
        for whole in it:
            for b in slices(whole, "__html"):
                found = [render(h) for h in b.column(b.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(b.num_columns - 1)]
                    + [pa.array([t for t, _ in found], pa.string()), pa.array([x for _, x in found], pa.string()),
                       pa.array([len(x) for _, x in found], pa.int64()),
                       pa.array([x.count("\n") + 1 if x else 0 for _, x in found], pa.int64())],
                    names=keep + ["title", "text", "n_chars", "n_lines"])

    return src.mapInArrow(run, schema)


def op6_html_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pages(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_rendering": op6_html_rendering}
SQL: dict = {}
