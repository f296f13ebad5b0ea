"""Layout-aware text of HTML pages.

The markup is read into a tree (implied start and end tags, void elements, raw text), invisible
parts are left out, and the rest is laid out as text: block elements on lines of their own with a
blank line where a page shows a margin, list items with their marks and indents, table cells in
columns of equal width, preformatted text as it stands, and other white space collapsed. Elements may
be open to any depth: places of open tags are indexed, and the tree is rendered with a stack of its own.

Time follows the length of the page whatever it holds: the markup is read once from left to right, where
a construct without an end takes the rest of the page with it, as in a browser, and text is copied once for
each table around it, up to ``TABLE_DEPTH``. Blanks that only align are bounded (``WIDE``, ``INDENT``).
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("audio canvas datalist dialog head iframe noscript object script style svg template title video".split())
#: Blocks with a margin above and below, and blocks without.
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
PLAIN = frozenset("address article aside body caption center dd details div dt figcaption footer form header html "
                  "legend li main nav option optgroup search section summary tr".split())
BLOCK = SPACED | PLAIN
_GROUPS = frozenset(("thead", "tbody", "tfoot"))
#: A start tag ends these open elements, up to the given boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "body": ({"head"}, {"html"})}
ENDS |= {g: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for g in _GROUPS}
#: An open paragraph ends where one of these starts.
_ENDS_P = BLOCK - {"body", "html", "option", "optgroup", "caption", "legend", "summary", "tr"}
_IN_HEAD = frozenset("base head html link meta noscript script style template title".split())
_CELLS = frozenset(("table", "td", "th"))
#: End tags that reach out of a cell.
_REACH = _GROUPS | {"table", "tr", "body"}
_SCOPE = frozenset("table td th caption button object template".split())
_BLANKS = re.compile(r"[ \t\n\r\f]+")
#: Elements whose content is text up to their end tag; character references count in the second kind.
RAW = frozenset("iframe noembed noframes script style xmp".split())
RAW_REFERENCES = frozenset(("textarea", "title"))
TABLE_DEPTH = 16    # tables nested deeper show their cells as blocks, one below the other
WIDE = 1000         # a cell that would start further right follows its neighbour after two blanks
CELL = 200          # wider cells do not widen their column
INDENT = 400        # deeper lists are not moved further right
COLUMNS, ROWS = 100, 1000  # that one cell may span


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


_NAME = re.compile(r"[^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
_UNQUOTED = re.compile(r"[^\s>]*")
_TAG_END = re.compile(r"[\s/]*>")
_COMMENT_END = re.compile(r"--!?>")
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW | RAW_REFERENCES}
_ZEROS, _HUGE = re.compile("&#0+(?=[0-9])"), re.compile("&#[1-9][0-9]{7,};?")


def _unescape(text: str) -> str:
    """Character references replaced; numbers of any length (beyond Unicode: U+FFFD)."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _HUGE.sub("\ufffd", _ZEROS.sub("&#", text))
    return html.unescape(text)


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from the end of its name on (the first of a name counts), and the place after
    the tag; -1 if the page ends within it."""
    found: dict[str, str] = {}
    while True:
        if end := _TAG_END.match(page, at):
            return found, end.end()
        m = _ATTRIBUTE.match(page, at)
        if not m:
            return found, -1
        at, value = m.end(), ""
        if m[2]:
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return found, -1
                value, at = page[at + 1:end], end + 1
            else:
                word = _UNQUOTED.match(page, at)
                value, at = word[0], word.end()
        found.setdefault(m[1].lower(), _unescape(value))


class _Builder:
    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)  # of each tag above the root, outermost first

    def feed(self, page: str) -> None:
        at, text = 0, []  # text: runs that no tag parts
        while at < len(page):
            lt = page.find("<", at)
            if lt < 0:
                text.append(page[at:])
                break
            text.append(page[at:lt])
            sign = page[lt + 1:lt + 2]
            closing = sign == "/"
            letter = page[lt + 2:lt + 3] if closing else sign
            if letter.isascii() and letter.isalpha():
                self._flush(text)
                name = _NAME.match(page, lt + 1 + closing)
                tag = name[0].lower()
                attrs, at = _attributes(page, name.end())
                if at < 0:
                    break
                if closing:
                    self.handle_endtag(tag)
                else:
                    at = self._start(tag, attrs, page, at)
            elif page.startswith("<!--", lt):
                self._flush(text)
                if short := re.compile("-?>").match(page, lt + 4):
                    at = short.end()
                else:
                    end = _COMMENT_END.search(page, lt + 4)
                    at = end.end() if end else len(page)
            elif sign in ("!", "?") and sign or closing and letter:
                self._flush(text)
                at = page.find(">", lt) + 1 or len(page)
            else:
                text.append("<")
                at = lt + 1
        self._flush(text)

    def _flush(self, text: list[str]) -> None:
        data = _unescape("".join(text))
        text.clear()
        if data:
            self.handle_data(data)

    def _start(self, tag: str, attrs: dict[str, str], page: str, at: int) -> int:
        """Open an element; the content of raw elements is read here. Returns where the markup goes on."""
        self.handle_starttag(tag, attrs)
        if tag == "plaintext":
            self.handle_data(page[at:])
            return len(page)
        if tag not in _CLOSE:
            return at
        end = _CLOSE[tag].search(page, at)
        data = page[at:end.start() if end else len(page)]
        if tag in RAW_REFERENCES:
            data = _unescape(data)
        if data:
            self.handle_data(data)
        return end.start() if end else len(page)

    def _last(self, tags) -> int:
        """The place of the innermost open element of ``tags``, 0 if there is none."""
        return max((at[-1] for t in tags if (at := self.places.get(t))), default=0)

    def _cut(self, i: int) -> None:
        """Pop the open elements from place ``i`` on."""
        while len(self.open) > i:
            self.places[self.open.pop().tag].pop()

    def _close(self, tags, boundary) -> None:
        """Pop the open elements down to the outermost one of ``tags`` above the boundary."""
        edge = self._last(boundary)
        while (i := self._last(tags)) > edge:
            self._cut(i)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.root.attrs = attrs | self.root.attrs
            return
        if self.open[-1].tag == "head" and tag not in _IN_HEAD:
            self._cut(len(self.open) - 1)
        if tag in ENDS:
            self._close(*ENDS[tag])
        if tag in _ENDS_P and self.places.get("p"):
            self._close({"p"}, _SCOPE)
        top = self.open[-1].tag
        if tag in ("td", "th") and top in (_GROUPS | {"table"}):  # the row is implied
            self._push(Node("tr", {}))
        node = Node(tag, attrs)
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _push(self, node):
        self.open[-1].children.append(node)
        self.places[node.tag].append(len(self.open))
        self.open.append(node)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag("br", {})
            return
        i = self._last((tag,))
        if tag == "p" and not i:
            self.open[-1].children.append(Node("p", {}))
        elif i and (tag in _REACH or i >= self._last(_CELLS)):  # other stray end tags do not reach out of a cell
            self._cut(i)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._cut(len(self.open) - 1)
        self.open[-1].children.append(data)


def _style(node: Node) -> dict[str, str]:
    """``display`` and ``visibility`` as the element's own style sets them."""
    found, firm = {}, set()
    for part in node.attrs.get("style", "").lower().split(";"):
        name, _, value = part.partition(":")
        name, (value, mark, _) = name.strip(), value.partition("!")
        if name in ("display", "visibility") and value.strip() and (mark or name not in firm):
            found[name] = value.strip()
            if mark:
                firm.add(name)
    return found


def shown(node: Node) -> bool:
    """Whether the element takes part in the layout; what is below an element that does not, neither does."""
    a = node.attrs
    display = _style(node).get("display") if "style" in a else None
    return not (node.tag in HIDDEN and not (node.tag == "dialog" and "open" in a) or display == "none"
                or "hidden" in a and not display or node.tag == "input" and a.get("type", "").lower() == "hidden")


def _seen(node: Node, seen: bool) -> bool:
    """Whether the element's own text shows: ``visibility`` is inherited, and any descendant may turn it back."""
    value = _style(node).get("visibility") if "style" in node.attrs else None
    return {"visible": True, "initial": True, "hidden": False, "collapse": False}.get(value, seen)


class _Layout:
    """Lines of text; ``due`` is the number of line ends due before the next text."""

    def __init__(self):
        self.lines: list[str] = []     # finished
        self.line: list[str] = []      # pieces of the last line
        self.due = 0        # 1: a new line, 2: after a blank line
        self.gap = False    # a collapsed blank is due
        self.depth = 0      # of the indent
        self.mark = ""      # of the list item that starts here

    def block(self, spaced: bool) -> None:
        self.due = max(self.due, 2 if spaced else 1)
        self.gap = False

    def _end(self) -> None:
        self.lines.append("".join(self.line))
        self.line = []

    def _begin(self) -> None:
        if self.due and (self.lines or self.line):
            self._end()
            self.lines += [""] * (self.due - 1)
        self.due = 0
        if not self.line and (self.depth or self.mark):
            indent = min(self.depth, INDENT)
            self.line.append(" " * (indent - len(self.mark)) + self.mark)
            self.mark = ""
            self.gap = False

    def text(self, data: str) -> None:
        parts = _BLANKS.split(data)
        for i, word in enumerate(parts):
            if i:
                self.gap = True
            if word:
                fresh = self.due or not self.line
                self._begin()
                if self.gap and not fresh:
                    self.line.append(" ")
                self.gap = False
                self.line.append(word)

    def raw(self, data: str) -> None:
        for i, line in enumerate(data.split("\n")):
            if i:
                self._end()
            if line:
                self._begin()
                self.line.append(line)

    def br(self) -> None:
        self._begin()
        self._end()
        self.gap = False

    def done(self) -> str:
        self._end()
        return "\n".join(x.rstrip(" \t") for x in self.lines).strip("\n")


def _rows(table: Node, seen: bool) -> list[tuple[Node, int, bool]]:
    """(row, number of its row group, whether text in it shows)."""
    out, group = [], 0
    for c in table.children:
        if isinstance(c, Node) and shown(c):
            if c.tag == "tr":
                out.append((c, group, _seen(c, seen)))
            elif c.tag in _GROUPS:
                group += 1
                within = _seen(c, seen)
                out += [(r, group, _seen(r, within)) for r in c.children if isinstance(r, Node) and r.tag == "tr" and shown(r)]
                group += 1
    return out


def _span(cell: Node, name: str, most: int) -> int:
    n = cell.attrs.get(name, "").strip()
    if name == "rowspan" and n == "0":  # to the end of the row group
        return most
    return min(most, max(1, int(n[:9]))) if n.isascii() and n.isdigit() else 1


def _table(table: Node, out: _Layout, seen: bool, depth: int) -> Iterator[Iterator]:
    """Captions and stray content as blocks, then the cells in columns of equal width (steps as in ``_render``).
    A cell of several rows or columns keeps its places free in each; its text stands in the first."""
    rows = _rows(table, seen)
    inside = {id(r) for r, _, _ in rows}
    for c in table.children:
        if isinstance(c, str):
            if seen:
                out.text(c)
        elif c.tag not in _GROUPS and id(c) not in inside:
            yield _render(c, out, False, seen, depth)
        elif c.tag in _GROUPS and shown(c):
            within = _seen(c, seen)
            for x in c.children:
                if isinstance(x, str):
                    if within:
                        out.text(x)
                elif x.tag != "tr":
                    yield _render(x, out, False, within, depth)
    if depth > TABLE_DEPTH:
        for r, _, within in rows:
            for c in r.children:
                out.block(False)
                if isinstance(c, Node):
                    yield _render(c, out, False, within, depth)
                elif within:
                    out.text(c)
                out.block(False)
        return
    grid, widths, broad = [], {}, []
    until: dict[int, tuple[int, int]] = {}  # first column of a cell: the first row and column that it leaves free
    last = None
    for number, (r, group, within) in enumerate(rows):
        if group != last:
            until, last = {}, group
        cells, column = [], 0
        for c in r.children:
            if isinstance(c, str):
                if not within or not c.strip():
                    continue
                lines, span, high = [" ".join(c.split())], 1, 1
            elif not shown(c):
                continue
            else:
                cell = _Layout()
                yield _render(c, cell, False, within, depth)
                lines = cell.done().split("\n")
                span, high = (_span(c, "colspan", COLUMNS), _span(c, "rowspan", ROWS)) if c.tag in ("td", "th") else (1, 1)
            while (held := until.get(column)) and held[0] > number:
                column = held[1]
            cells.append((column, lines))
            width = max(map(len, lines))
            widths[column] = max(widths.get(column, 0), width if span == 1 and width <= CELL else 0)
            if 1 < span and width <= CELL:
                broad.append((column, column + span, width))
            if high > 1:
                until[column] = number + high, column + span
            column += span
        grid.append(cells)
    order = sorted(widths)  # the columns in which a cell starts
    for low, high, width in broad:  # what a broad cell needs beyond its columns widens the last of them
        under = order[bisect_left(order, low):bisect_left(order, high)]
        widths[under[-1]] += max(0, width - sum(widths[c] + 2 for c in under) + 2)
    starts, at = {}, 0
    for column in order:
        starts[column] = at if at <= WIDE else 0
        at += widths[column] + 2
    for cells in grid:
        text = []
        for k in range(max((len(x) for _, x in cells), default=0)):
            line, length = [], 0
            for column, lines in cells:
                piece = lines[k] if k < len(lines) else ""
                if not piece:
                    continue
                blanks = max(starts[column] - length, 2 if line else 0)
                line += (" " * blanks, piece)
                length += blanks + len(piece)
            text.append("".join(line).rstrip())
        if any(text):
            out.block(False)
            out.raw("\n".join(text))
            out.block(False)


def _render(node: Node, out: _Layout, pre: bool, seen: bool = True, depth: int = 0) -> Iterator[Iterator]:
    """Lay a node out; yields the steps of its descendants, each to be finished before this one goes on."""
    if not shown(node):
        return
    tag = node.tag
    seen = _seen(node, seen)
    if tag == "br":
        out.br()
        return
    if tag == "table":
        out.block(True)
        yield _table(node, out, seen, depth + 1)
        out.block(True)
        return
    if tag in ("td", "th"):
        out.gap = True
    kept = out.depth
    nested = tag in ("ul", "ol", "menu", "dl") and bool(out.depth or out.mark)
    if tag in BLOCK:
        out.block(tag in SPACED and not nested)
    if tag == "dd":
        out.depth += 4
    pre = pre or tag in ("pre", "textarea", "listing", "plaintext", "xmp")
    number = None
    if tag == "ol":
        start = node.attrs.get("start", "").strip()
        number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
    children = node.children
    if tag == "details" and "open" not in node.attrs:
        children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
    for c in children:
        if isinstance(c, str):
            if seen:
                out.raw(c) if pre else out.text(c)
        elif tag in ("ul", "ol", "menu") and c.tag == "li" and shown(c):
            mark = "- "
            if number is not None:
                value = c.attrs.get("value", "").strip()
                number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else number
                mark = f"{number}. "
                number += 1
            held = out.depth
            out.block(False)
            out.depth, out.mark = held + len(mark), mark if _seen(c, seen) else ""
            yield _render(c, out, pre, seen, depth)
            out.depth, out.mark = held, ""
        else:
            yield _render(c, out, pre, seen, depth)
    out.depth = kept
    if tag in BLOCK:
        out.block(tag in SPACED and not nested)
    elif tag in ("td", "th"):
        out.gap = True


def render_node(node: Node) -> str:
    out = _Layout()
    steps = [_render(node, out, False)]
    while steps:
        inner = next(steps[-1], None)
        if inner is None:
            steps.pop()
        else:
            steps.append(inner)
    return out.done()


def page_text(page: str) -> str:
    """The visible text of one page."""
    builder = _Builder()
    builder.feed(page)
    return render_node(builder.root)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id and ``text``.

    Null markup gives null, empty markup an empty text, text without tags itself with white space
    collapsed. Unclosed and stray tags are repaired as far as a browser would show their text, at any
    depth; a tag, comment or quoted value that never ends hides the rest of the page. Null ids and repeated rows stay
    rows of their own; pages are read whole; an empty table gives no rows; other columns are ignored.
    """
    def start():
        return lambda pages: {"text": [None if p is None else page_text(p) for p in pages]}
    return map_texts(pages, html_col, [id_col], T.StructType([T.StructField("text", T.StringType())]), start)
