"""Layout-aware rendering of HTML to text.

A tree builder adds implied end tags (a block closes an open paragraph, a list item or a
table cell closes the one before, what a head may not contain closes it, HTML elements end
an open svg or math) and visibility rules drop what a browser would not show.
The renderer emits all visible text: blocks and paragraphs keep their spacing, list items
their markers and nesting, preformatted text its lines, and table cells are aligned in
columns.  Everything is iterative, so depth and length of a page are unbounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.common import bounded_batches, slices, text_column

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title datalist object audio video canvas".split())
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())  # a head may contain these
# svg and math: what they do not show, what holds HTML in them, and the HTML that ends them
FOREIGN_HIDDEN = frozenset("title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter style script "
                           "annotation annotation-xml mphantom".split())
HTML_POINT = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
                     "pre ruby s small span strong strike sub sup table tt u ul var".split())
APART = frozenset("mfrac msup msub msubsup mroot munder mover munderover mmultiscripts".split())  # their parts are not one word
# lines before and after an element: 1 starts a new line, 2 leaves an empty one
SPACING = {t: 1 for t in "html body div section article header footer nav aside main address form fieldset legend figcaption li dt dd "
           "tr caption summary details option optgroup hgroup center dir".split()}
SPACING |= {t: 2 for t in "p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure hr".split()}
SPACING |= {"text": 1, "mtr": 1}  # of svg and math
CLOSES_P = frozenset(t for t in SPACING if t not in ("tr", "caption", "option", "optgroup", "html", "body", "text", "mtr"))
# an opening tag closes these open elements, up to a boundary
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
           "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th", "caption"}, {"table", "tr"}),
           "th": ({"td", "th", "caption"}, {"table", "tr"}), "body": ({"head"}, set())}
IMPLIED |= {t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")}
SCOPE = frozenset("table td th caption html template object".split())
CELL = frozenset(("td", "th"))
MAX_PAD = 60  # a cell is padded to at most this width; a wider one keeps its text and shifts the next

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_CLOSE = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_SPACE = re.compile(r"[ \t\n\r\f]+")
_UNQUOTED_END = re.compile(r"=\s*[^\s\"'=]+/$")  # the slash belongs to the value
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "hidden", "foreign")

    def __init__(self, tag: str, attrs: dict[str, str], hidden: bool, foreign: bool = False):
        self.tag, self.attrs, self.children, self.hidden = tag, attrs, [], hidden
        self.foreign = foreign  # the children are svg or math


def _tag_end(s: str, at: int, missing: set[str]) -> int:
    """Place of the ``>`` that ends a tag; quoted values may contain one.  A quote that is
    never closed counts as an ordinary character (``missing`` remembers it)."""
    n = len(s)
    while True:
        gt = s.find(">", at)
        if gt < 0:
            return n
        q = min((p for p in (s.find(c, at, gt) for c in "\"'" if c not in missing) if p >= 0), default=-1)
        if q < 0:
            return gt
        close = s.find(s[q], q + 1)
        if close < 0:
            missing.add(s[q])
        else:
            at = close + 1


def _shown(tag: str, attrs: dict[str, str], foreign: bool) -> bool:
    if foreign and (tag in FOREIGN_HIDDEN or attrs.get("display") == "none" or attrs.get("visibility") in ("hidden", "collapse")):
        return False
    if tag in HIDDEN or "hidden" in attrs or tag == "dialog" and "open" not in attrs:
        return False
    return not ("style" in attrs and _INVISIBLE.search(attrs["style"]))


def parse(s: str) -> Node:
    """The element tree.  Text nodes are strings."""
    root = Node("html", {}, False)
    stack = [root]
    missing: set[str] = set()
    at, n = 0, len(s)

    def close(tags, boundary) -> None:
        for k in range(len(stack) - 1, 0, -1):
            t = stack[k].tag
            if t in tags:
                del stack[k:]
                return close(tags, boundary) if len(tags) > 1 else None
            if t in boundary:
                return None

    def put(t: str) -> None:
        if stack[-1].tag == "head" and unescape(t).strip(" \t\n\r\f"):
            stack.pop()
        stack[-1].children.append(t)

    while at < n:
        lt = s.find("<", at)
        if lt < 0:
            put(s[at:])
            break
        if lt > at:
            put(s[at:lt])
        nxt = s[lt + 1:lt + 2]
        if nxt == "!":
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif stack[-1].foreign and s.startswith("<![CDATA[", lt):
                end = s.find("]]>", lt)
                put(s[lt + 9:n if end < 0 else end].replace("&", "&amp;"))
                at = n if end < 0 else end + 3
            else:
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _NAME.match(s, lt + (2 if nxt == "/" else 1))
        if not m:
            if nxt in ("/", "?"):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                put("<")
                at = lt + 1
            continue
        tag = m.group().lower()
        end = _tag_end(s, m.end(), missing)
        body = s[m.end():end]
        at = end + 1
        if nxt == "/":
            if tag == "br":
                if stack[-1].tag == "head":
                    stack.pop()
                stack[-1].children.append(Node("br", {}, False))
                continue
            for k in range(len(stack) - 1, 0, -1):
                t = stack[k].tag
                if t == tag:
                    del stack[k:]
                    break
                if t in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "html", "body"):
                    break
            continue
        attrs = {a.lower(): unescape(b or c or d) for a, b, c, d in reversed(_ATTR.findall(body))} if body.strip(" /\n\t") else {}
        if tag in ("html", "body") and len(stack) > 1 and any(x.tag == tag for x in stack) or tag == "html":
            continue
        if stack[-1].tag == "head":
            if tag == "head":
                continue
            if tag not in HEAD:
                stack.pop()
        if tag in BREAKOUT:
            while stack[-1].foreign:
                stack.pop()
        inside = stack[-1].foreign
        if tag in CLOSES_P and not inside:
            close(("p",), SCOPE)
        if tag in IMPLIED and not inside:
            close(*IMPLIED[tag])
        node = Node(tag, attrs, stack[-1].hidden or not _shown(tag, attrs, inside),
                    tag in ("svg", "math") or inside and tag not in HTML_POINT)
        stack[-1].children.append(node)
        if inside or node.foreign:
            if not (body.endswith("/") and not _UNQUOTED_END.search(body)):
                stack.append(node)
        elif tag in RAW:
            m = _CLOSE[tag].search(s, at)
            stop = m.start() if m else n
            if tag in ("textarea", "xmp") and stop > at:
                node.children.append(s[at:stop])
            end = s.find(">", stop)
            at = n if end < 0 else end + 1
        elif tag not in VOID:
            stack.append(node)
    return root


class Writer:
    """Lines of one block container (the page or a table cell)."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the open line
        self.gap = 0
        self.indent = ""
        self.marker: str | None = None
        self.space = False  # white space is due before the next text

    def text(self, t: str) -> None:
        flat = _SPACE.sub(" ", t)
        if flat == " ":
            self.space = self.space or bool(self.parts)
            return
        if not flat:
            return
        if flat[0] == " ":
            self.space = True
            flat = flat[1:]
        trailing = flat.endswith(" ")
        self._put((" " if self.space and self.parts else "") + flat.rstrip(" "))
        self.space = trailing

    def _put(self, t: str) -> None:
        if not self.parts:
            if self.gap > 1 and self.lines and self.lines[-1] != "":
                self.lines.append("")
            self.parts.append(self.indent + (self.marker or ""))
            if self.marker:
                self.indent += " " * len(self.marker)
                self.marker = None
        self.gap = 0
        self.parts.append(t)

    def raw(self, lines: list[str]) -> None:
        """Lines as they are (preformatted text, table rows)."""
        for k, x in enumerate(lines):
            if k:
                self.newline()
            if x:
                self._put(x)
            elif k and k + 1 < len(lines):
                self.lines.append("")

    def newline(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip(" "))
            self.parts = []
        self.space = False

    def block(self, gap: int) -> None:
        self.newline()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.newline()
        return self.lines


def _columns(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Table rows as lines with aligned cells; a cell is (lines, colspan)."""
    width: dict[int, int] = {}
    for row in rows:
        c = 0
        for lines, span in row:
            if span == 1:
                width[c] = max(width.get(c, 0), min(MAX_PAD, max(map(len, lines), default=0)))
            c += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            parts, c = [], 0
            for lines, span in row:
                room = sum(width.get(x, 0) for x in range(c, c + span)) + 2 * (span - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(room))
                c += span
            out.append("  ".join(parts).rstrip(" "))
    return out


def render(root: Node) -> tuple[str, dict[str, int]]:
    """The visible text and counts of hidden elements, list items and tables."""
    stats = {"hidden": 0, "items": 0, "tables": 0}
    writers = [Writer()]
    tables: list[list[list]] = []
    lists: list[list] = []
    pre = 0
    # (node, None) opens a node, (node, saved) closes it
    todo: list[tuple] = [(root, None)]
    while todo:
        node, saved = todo.pop()
        w = writers[-1]
        if isinstance(node, str):
            if pre:
                w.raw(unescape(node).replace("\r\n", "\n").split("\n"))
            else:
                w.text(unescape(node))
            continue
        tag = node.tag
        if saved is None:
            if node.hidden:
                stats["hidden"] += 1
                continue
            if tag == "br":
                if not w.parts and w.lines and w.gap == 0:
                    w.lines.append("")
                w.newline()
                continue
            if tag == "img":
                if node.attrs.get("alt"):
                    w.text(node.attrs["alt"])
                continue
            if tag == "input":
                if node.attrs.get("type", "text").lower() in ("submit", "button", "reset") and node.attrs.get("value"):
                    w.text(f" {node.attrs['value']} ")
                continue
            gap = SPACING.get(tag, 0)
            if gap == 2 and tag in ("ul", "ol") and lists:
                gap = 1
            keep = (w.indent, gap)
            if gap:
                w.block(gap)
            if tag == "table":
                stats["tables"] += 1
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in CELL and tables:
                if not tables[-1]:
                    tables[-1].append([])
                writers.append(Writer())
            elif tag in ("ul", "ol", "menu", "dir"):
                start = node.attrs.get("start", "1").strip()
                lists.append([tag == "ol", int(start) if re.fullmatch(r"[0-9]{1,9}", start) else 1])
                if len(lists) > 1:
                    w.indent += ""
            elif tag == "li":
                stats["items"] += 1
                here = lists[-1] if lists else [False, 1]
                w.marker = f"{here[1]}. " if here[0] else "- "
                here[1] += 1
            elif tag in ("dd", "blockquote"):
                w.indent += "  "
            elif tag == "pre":
                pre += 1
            elif tag == "hr":
                w.text("---")
                w.block(2)
                continue
            todo.append((node, keep))
            kids = node.children
            if tag == "details" and "open" not in node.attrs:
                kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
            if tag in APART:
                kids = [x for k in kids for x in (k, " ")][:-1]
            for k in reversed(kids):
                if not (tag in ("table", "tr", "tbody", "thead", "tfoot") and isinstance(k, str) and not k.strip()):
                    todo.append((k, None))
            continue
        indent, gap = saved
        if tag in CELL and tables and len(writers) > 1:
            cell = writers.pop().done()
            span = node.attrs.get("colspan", "1").strip()
            tables[-1][-1].append((cell, max(1, min(1000, int(span))) if re.fullmatch(r"[0-9]{1,9}", span) else 1))
            continue
        if tag == "table" and tables:
            lines = _columns(tables.pop())
            if lines:
                w.block(2)
                for x in lines:
                    w.raw([x])
                    w.newline()
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "li":
            if w.marker is not None:  # an item without text
                w._put("")
                w.newline()
            w.marker = None
        elif tag == "pre":
            pre -= 1
        if gap:
            w.block(gap)
        w.indent = indent
    while len(writers) > 1:
        cell = writers.pop().done()
        writers[-1].raw(cell)
    lines = writers[0].done()
    return "\n".join(lines).strip("\n"), stats


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text, n_chars, n_lines, n_tables, n_list_items, n_hidden) for every page.

    A null or empty page renders to the empty text; broken markup never fails; ids may be
    null or repeat; an empty table gives an empty result."""
    thin = bounded_batches(pages).select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    kind = thin.schema["_id"].dataType.simpleString()
    counts = ("n_chars", "n_lines", "n_tables", "n_list_items", "n_hidden")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, cols = [], []
            for s in text_column(b, "_html"):
                t, st = render(parse(s))
                texts.append(t)
                cols.append((len(t), t.count("\n") + 1 if t else 0, st["tables"], st["items"], st["hidden"]))
            e = list(zip(*cols)) if cols else [()] * len(counts)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(texts, pa.string()), *[pa.array(c, pa.int64()) for c in e]],
                                             names=["_id", "text", *counts])

    return thin.mapInArrow(run, f"_id {kind}, text string, " + ", ".join(f"{c} long" for c in counts)).withColumnRenamed("_id", id_col)
