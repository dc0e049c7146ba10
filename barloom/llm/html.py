"""HTML extraction by layout: a tree builder with implied tags, visibility rules and a text renderer.

``render`` gives all visible text of a page. Blocks start new lines, with a
blank line around paragraphs, headings, lists, tables and the like; list items
carry bullets or numbers and are indented by depth; table cells, which may have
several lines, are padded to aligned columns; ``pre`` keeps its white space. Of a
drop-down list the chosen option shows, of a list box all. Scripts run, so
``noscript`` is hidden. A cell spans at most 1000 columns, as in browsers.

Elements may be nested to any depth: open elements are found by tag and flows
are walked with a stack of their own, so a page takes time in proportion to its
length. Lists, quotes and tables nested in more than 40 others are shown as plain
blocks, without further indents and columns. Null or empty HTML renders as an empty string; broken markup never raises. Rows
are kept one for one, repeats included; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript title meta link datalist iframe object svg canvas audio video noembed noframes param".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split())
BLOCK = SPACED | frozenset("html body address article aside details dialog dd div dt figcaption footer form header hgroup legend li main menu nav section summary center caption tr option optgroup".split())
PARTS = frozenset("tbody thead tfoot tr td th".split())
# What an opening tag closes, and the ancestors beyond which it does not look.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"})}
CLOSES |= {t: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")}
ENDS_P = BLOCK - {"tr", "caption", "html", "body", "option", "optgroup", "legend", "summary"} | {"li", "dd", "dt"}
HEAD_ONLY = frozenset("title meta link style script base template noscript".split())
NESTED = 40  # lists, quotes and tables in one another that are laid out


class Node:
    __slots__ = ("attrs", "kids", "parts", "tag")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.parts = False  # rows or cells below, other than those of a table in it


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTR.finditer(source):
        value = m[2] or ""
        if value[:1] in "\"'" and len(value) > 1:
            value = value[1:-1]
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


class _Open:
    """The open elements, and for each tag the depths at which it is open."""

    def __init__(self, root: Node) -> None:
        self.stack = [root]
        self.at: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        """Closes all from ``depth`` on."""
        while len(self.stack) > depth:
            self.at[self.stack.pop().tag].pop()

    def nearest(self, tags: Iterable[str]) -> int:
        """The greatest depth of any of the tags; 0 if none is open."""
        return max((found[-1] for t in tags if (found := self.at.get(t))), default=0)

    def close(self, targets: Iterable[str], limit: Iterable[str]) -> None:
        """Closes the outermost target that stands deeper than the nearest limit, and all in it."""
        top = self.nearest(limit)
        first = [found[k] for t in targets if (found := self.at.get(t)) and (k := bisect_right(found, top)) < len(found)]
        if first:
            self.cut(min(first))


def parse(source: str) -> Node:
    """The element tree, with implied html, head, body, tbody and row elements and implied end tags."""
    root = Node("#root")
    held = _Open(root)
    stack, close = held.stack, held.close
    in_body = False

    def add(node: Node) -> None:
        stack[-1].kids.append(node)
        if node.tag in PARTS:
            for above in reversed(stack):
                if above.parts or above.tag == "table":
                    break
                above.parts = True

    def open_(tag: str, attrs: str = "") -> None:
        node = Node(tag, attrs)
        add(node)
        held.push(node)

    def ensure(tag: str) -> None:
        nonlocal in_body
        if len(stack) == 1:
            open_("html")
        if in_body or tag in ("html", "head", "body"):
            return
        if tag in HEAD_ONLY:
            if len(stack) == 2 and stack[-1].tag == "html":
                open_("head")
            return
        close({"head"}, ())
        open_("body")
        in_body = True

    def text(data: str) -> None:
        if not data or (not in_body and not data.strip()):
            return
        if stack[-1].tag not in RAW and stack[-1].tag != "head":
            ensure("#text")
        elif stack[-1].tag == "head":
            ensure("#text")
        stack[-1].kids.append(data)

    at, n = 0, len(source)
    while at < n:
        m = TOKEN.search(source, at)
        if not m:
            text(html.unescape(source[at:]))
            break
        if m.start() > at:
            text(html.unescape(source[at : m.start()]))
        at = m.end()
        if m[1] is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[1].lower()
        if m[0][1] == "/":
            if tag == "br":
                ensure(tag)
                stack[-1].kids.append(Node("br"))
                continue
            limit = {"td", "th", "table"} if tag not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html") else ({"table"} if tag not in ("table", "body", "html") else set())
            mine = held.nearest((tag,))
            if mine and mine >= held.nearest(limit) and tag not in ("html", "body"):
                held.cut(mine)
            continue
        if tag == "html":
            if len(stack) == 1:
                open_("html", m[2])
            continue
        if tag == "body":
            if not in_body:
                ensure("head")
                close({"head"}, ())
                open_("body", m[2])
                in_body = True
            continue
        if tag == "head":
            if not in_body and len(stack) <= 2:
                ensure("html")
                open_("head", m[2])
            continue
        ensure(tag)
        if tag in ENDS_P:
            close({"p"}, {"td", "th", "table", "div", "li", "blockquote", "section", "article", "body"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", stack[-1].tag):
            held.cut(len(stack) - 1)
        near = held.nearest(("table", "tr", "tbody", "thead", "tfoot"))
        here = stack[near].tag if near else ""
        if tag == "tr" and here == "table":
            open_("tbody")
        if tag in ("td", "th") and here in ("table", "tbody", "thead", "tfoot"):
            if here == "table":
                open_("tbody")
            open_("tr")
        if tag in VOID:
            stack[-1].kids.append(Node(tag, m[2]))
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            body = source[at : end.start() if end else n]
            node = Node(tag, m[2])
            node.kids.append(html.unescape(body) if tag in ("textarea", "title") else body)
            stack[-1].kids.append(node)
            at = end.end() if end else n
        else:
            open_(tag, m[2])
    return root


def visible(node: Node) -> bool:
    """False for elements that a browser does not show: by tag, hidden, aria-hidden or inline style."""
    if node.tag in HIDDEN:
        return False
    if node.attrs and re.search(r"hidden|style|type|open", node.attrs, re.I):
        a = attributes(node.attrs)
        if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
            return False
        style = re.sub(r"\s+", "", a.get("style", "").lower())
        if re.search(r"(?:^|;)(?:display:none|visibility:(?:hidden|collapse)|opacity:0(?:\.0+)?(?:;|!|$))", style):
            return False
    return True


class _Lines:
    """Collects lines; white space folds, and blank lines between blocks never double."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False

    def words(self, data: str) -> None:
        folded = re.sub(r"[ \t\n\r\f]+", " ", data)
        if folded.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            folded = folded[1:]
        if folded:
            self.line.append(folded)

    def end(self, blank: bool = False) -> None:
        joined = "".join(self.line).rstrip(" ")
        self.line = []
        if joined:
            self.put([joined])
        self.blank |= blank

    def put(self, lines: list[str]) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines.extend(lines)


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def _grid(table: Node, level: int) -> tuple[list[list[list[str]]], Node]:
    """The rows of cells, also of those below forms and the like, and all that stands between the cells."""
    rows: list[list[list[str]]] = []
    loose = Node("#loose")

    def walk(node: Node, cells: list[list[str]] | None, depth: int) -> None:
        stray: list[Node | str] = []
        for kid in node.kids:
            if isinstance(kid, str):
                stray.append(kid)
            elif not visible(kid) or (kid.tag == "caption" and node is table):
                continue
            elif kid.tag in ("td", "th"):
                if cells is None:
                    rows.append(cells := [])
                span = attributes(kid.attrs).get("colspan", "1")
                cells.append(_rendered(kid, level))
                cells += [[]] * (min(int(span[:9]), 1000) - 1 if span.isascii() and span.isdigit() and int(span[:9]) > 1 else 0)
            elif kid.tag == "tr" and depth < NESTED:
                rows.append([])
                walk(kid, rows[-1], depth + 1)
            elif depth < NESTED and (kid.tag in PARTS or (kid.tag != "table" and kid.parts)):
                walk(kid, cells, depth + 1)
            else:
                stray.append(kid)
        if any(isinstance(x, Node) or x.strip() for x in stray):
            loose.kids += [Node("br"), *stray] if loose.kids else stray

    walk(table, None, 0)
    return [r for r in rows if any(r)], loose


def _table(table: Node, level: int) -> tuple[list[str], list[str]]:
    """Lines of what stands outside the cells, and of the cells."""
    rows, loose = _grid(table, level)
    widths: list[int] = []
    for r in rows:
        widths += [0] * (len(r) - len(widths))
        for i, c in enumerate(r):
            widths[i] = max([widths[i], *map(_width, c)])
    out: list[str] = []
    for r in rows:
        for k in range(max(map(len, r))):
            line = ((i, c[k] if k < len(c) else "") for i, c in enumerate(r))
            out.append("  ".join(x + " " * (widths[i] - _width(x)) for i, x in line).rstrip())
    return _rendered(loose, level), out


def _chosen(select: Node) -> list[Node]:
    """The options that a list shows: all of a box, else the last one selected, or the first."""
    options: list[Node] = []
    work = [select]
    while work:
        node = work.pop()
        if node.tag == "option":
            options.append(node)
        else:
            work += [k for k in reversed(node.kids) if isinstance(k, Node) and visible(k)]
    a = attributes(select.attrs)
    size = a.get("size", "1")
    if "multiple" in a or (size.isascii() and size.isdigit() and int(size[:9]) > 1):
        return options
    return [o for o in options if "selected" in attributes(o.attrs)][-1:] or options[:1]


def _rendered(node: Node, level: int = 0) -> list[str]:
    """Lines of a node that stands in ``level`` lists, quotes and tables."""
    out = _Lines()
    _flow(node, out, level + 1)
    out.end()
    return out.lines


def _item(node: Node, bullet: str, level: int) -> list[str]:
    inner = _rendered(node, level)
    if not inner:
        return []
    pad = " " * len(bullet)
    return [bullet + inner[0], *(pad + x if x else x for x in inner[1:])]


def _list(node: Node, nested: bool, out: _Lines, level: int) -> None:
    out.end(not nested)
    start = attributes(node.attrs).get("start", "1") if node.tag == "ol" else "1"
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    for item in node.kids:
        if isinstance(item, str):
            if item.strip():
                out.words(item)
                out.end()
        elif visible(item):
            if item.tag == "li":
                lines = _item(item, f"{number}. " if node.tag == "ol" else "- ", level)
                number += 1
            else:
                holder = Node("#item")
                holder.kids = [item]
                lines = _rendered(holder, level)
            if lines:
                out.put(lines)
    out.end(not nested)


def _flow(node: Node, out: _Lines, level: int) -> None:
    """Adds what stands in a node; ``level`` counts the lists, quotes and tables around, beyond ``NESTED`` of which all are plain blocks."""
    laid_out = level <= NESTED
    work = [(iter(node.kids), node, False, False)]  # what is left of a node, the node, and whether its end ends a block and a spaced one
    while work:
        kids, parent, block, spaced = work[-1]
        kid = next(kids, None)
        if kid is None:
            work.pop()
            if block:
                out.end(spaced)
            continue
        if isinstance(kid, str):
            out.words(kid)
            continue
        tag = kid.tag
        if not visible(kid):
            continue
        if tag == "br":
            joined = "".join(out.line).rstrip(" ")
            if joined:
                out.put([joined])
            out.line = []
        elif tag == "hr":
            out.end(True)
        elif tag == "img":
            out.words(attributes(kid.attrs).get("alt", ""))
        elif tag == "input":
            a = attributes(kid.attrs)
            if a.get("type", "text").lower() in ("button", "submit", "reset", "text"):
                out.words(a.get("value", ""))
        elif tag == "select":
            for option in _chosen(kid):
                out.words(f" {attributes(option.attrs).get('label') or ''.join(_plain(option))} ")
        elif tag == "pre":
            out.end(True)
            body = "".join(_plain(kid)).replace("\r\n", "\n").removeprefix("\n").rstrip()
            if body.strip():
                out.put([x.rstrip() for x in body.split("\n")])
            out.end(True)
        elif tag in ("ul", "ol", "menu") and laid_out:
            _list(kid, parent.tag == "li", out, level)
        elif tag == "table" and laid_out:
            out.end(True)
            for caption in (c for c in kid.kids if isinstance(c, Node) and c.tag == "caption" and visible(c)):
                if lines := _rendered(caption, level):
                    out.put(lines)
            for lines in _table(kid, level):
                if lines:
                    out.put(lines)
            out.end(True)
        elif tag in ("dd", "blockquote") and laid_out:
            out.end(tag == "blockquote")
            if lines := _rendered(kid, level):
                out.put([f"  {x}" if x else x for x in lines])
            out.end(tag == "blockquote")
        else:
            block = tag in BLOCK or tag in PARTS
            if block:
                out.end(tag in SPACED)
            work.append((iter(kid.kids), kid, block, tag in SPACED))


def _plain(node: Node) -> list[str]:
    out: list[str] = []
    work: list[Node | str] = [node]
    while work:
        x = work.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is node or visible(x):
            out += ["\n"] if x.tag == "br" else []
            work += reversed(x.kids)
    return out


def render(source: str | None) -> str:
    """All visible text of one page."""
    return "\n".join(_rendered(parse(source))).strip("\n") if source else ""



def extract_text(df: DataFrame, key: str = "page_id", html_column: str = "html") -> DataFrame:
    """page_id, text, n_lines."""

    def run(keys: list, pages: list) -> list:
        out = [render(x) for x in pages]
        return [keys, out, [x.count("\n") + 1 if x else 0 for x in out]]

    fields = [("page_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64())]
    rows = df.select(F.col(key).cast("bigint").alias("page_id"), F.col(html_column).cast("string").alias("html"))
    return rows.mapInArrow(batches(run, fields), "page_id bigint, text string, n_lines bigint")
