"""HTML extraction by layout-aware rendering.

A small tokenizer feeds a tree of open elements that knows which end tags are
implied (a p ends where a block begins, an li at the next li, cells at the next cell,
row or table) and which elements are not shown (head, scripts, templates, ``hidden``,
``display:none``; ``visibility:hidden`` until something inside is ``visible`` again). What is shown is laid out as text: one
blank line around paragraphs, headings, lists and tables, one newline around other blocks,
list items with their bullets or numbers and indented by nesting, and table cells in aligned columns, with
cells that span columns or rows and cells of several lines in their places.

Cells are aligned whatever their width (``widest`` can bound what widens a column). Where the padding of a table, with that of the tables in it, would
come to more than ``MOST_PADDING`` times its text, its cells stand one under the other, so a page's text is bounded by a multiple of
what it says; lines are not indented by more than ``MOST_INDENT`` columns; a row minds ``MOST_SPANNED`` cells that reach down into it. None of this loses text. What is laid out once
is shared by the tables around it, not laid out again.

Defined results: null html gives null text, empty or invisible html an empty text;
broken markup is never an error (unknown or unclosed tags, stray ends, a lone < are text or ignored as
browsers do; a tag with an unclosed quote ends at its first >); nesting of any depth is handled without recursion and in
time that grows with the page's length; an empty table stays empty; other columns are carried, whatever their names, but for one called
``_text``, which the result replaces.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# fixed values of HTML: element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPED_RAW = frozenset("textarea title".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes title audio video canvas datalist desc defs metadata symbol annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr menu".split())
BLOCK = SPACED | frozenset(
    "address article aside body center dd details dialog dir div dt fieldset figcaption footer form header html legend li main nav optgroup option section summary tr caption".split()
)
ENDS_P = (BLOCK | {"hr"}) - frozenset("body html tr caption option optgroup".split())
IN_HEAD = frozenset("title style script meta link base template noscript head basefont bgsound".split())
LISTS = frozenset("ul ol menu dir".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
CELLS = frozenset(("td", "th"))
#: What an opening tag ends: open elements of these names, up to a boundary.
IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}), "tbody": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": (ROW_GROUPS | {"tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: An end tag does not reach beyond these.
SCOPE = frozenset(("table", "td", "th", "caption", "html"))
#: A cell wider than this does not widen its column; None: every cell does.
WIDEST: int | None = None
#: A table's lines have so many characters for each of its text at most; beyond, its cells stand one under the other.
MOST_PADDING = 8
#: Cells that reach into rows below, kept in mind at once; beyond, a cell is taken to end in its row.
MOST_SPANNED = 256
MOST_INDENT = 80
#: A cell spans so many rows or columns at most, as in browsers.
MOST_SPAN = 1000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)([^>]*)>?|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DISPLAY = re.compile(r"(?<![\w-])display\s*:\s*([\w-]+)", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*([\w-]+)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class _Block:
    """Laid-out lines: strings, and parts of other blocks with an indent, which are shared and not copied.

    ``height`` counts lines, ``width`` bounds their lengths, ``size`` their sum, and ``text`` counts what is no padding.
    """

    __slots__ = ("items", "height", "width", "size", "text")

    def __init__(self, text: int = 0):
        self.items: list = []
        self.height = self.width = self.size = 0
        self.text = text

    def add(self, line: str) -> None:
        self.items.append(line)
        self.height, self.width, self.size = self.height + 1, max(self.width, len(line)), self.size + len(line)

    def put(self, indent: int, block: _Block, lo: int, hi: int) -> None:
        """Lines lo to hi (exclusive) of another block."""
        self.items.append((indent, block, lo, hi))
        self.height, self.width = self.height + hi - lo, max(self.width, indent + block.width)
        self.size += indent * (hi - lo) + (block.size if hi - lo == block.height else block.size * (hi - lo) // block.height)

    def lines(self, lo: int = 0, hi: int | None = None) -> Iterator[str]:
        """Lines lo to hi, without recursion: a frame is a block, its next item, lines to skip, lines to give, and its indent."""
        stack = [[self, 0, lo, (self.height if hi is None else hi) - lo, 0]]
        while stack:
            frame = stack[-1]
            block, at, skip, left, indent = frame
            if left <= 0 or at == len(block.items):
                stack.pop()
                continue
            item, frame[1] = block.items[at], at + 1
            n = 1 if isinstance(item, str) else item[3] - item[2]
            if skip >= n:
                frame[2] = skip - n
                continue
            taken = min(n - skip, left)
            frame[2], frame[3] = 0, left - taken
            if isinstance(item, str):
                yield " " * indent + item
            else:
                if frame[3] <= 0 or frame[1] == len(block.items):
                    stack.pop()  # nothing follows: a chain of blocks within blocks stays one frame deep
                stack.append([item[1], 0, item[2] + skip, taken, indent + item[0]])


class _Sink:
    """Lines of text being laid out."""

    def __init__(self) -> None:
        self.lines: list = []  # strings, and (indent, block)
        self.line: list[str] = []
        self.gap = 0  # blank lines owed before the next text
        self.space = False  # a collapsed space owed
        self.fresh = False  # the line holds nothing but a list item's mark

    def text(self, s: str, indent: int) -> None:
        """Inline text with white space collapsed."""
        lead, core, tail = s[:1] in " \t\n\r\f", _SPACE.sub(" ", s.strip(" \t\n\r\f")), s[-1:] in " \t\n\r\f"
        if not core:
            self.space |= bool(s) and bool(self.line)
            return
        if not self.line:
            self._open(indent)
        elif (self.space or lead) and not self.fresh:
            self.line.append(" ")
        self.line.append(core)
        self.space, self.fresh = tail, False

    def exact(self, s: str, indent: int) -> None:
        """Preformatted text."""
        for i, part in enumerate(s.split("\n")):
            if i:
                self.end_line(force=True)
            if part:
                self.fresh = False
                if not self.line:
                    self._open(indent)
                self.line.append(part)

    def _open(self, indent: int) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.line.append(" " * min(indent, MOST_INDENT))

    def mark(self, s: str, indent: int) -> None:
        """A list item's mark; what comes next stands beside it."""
        self.end_line()
        self._open(indent)
        self.line.append(s)
        self.fresh = True

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        elif force:
            self.gap += bool(self.lines)
        self.line, self.space, self.fresh = [], False, False

    def margin(self, blank: int) -> None:
        if self.fresh:
            return
        self.end_line()
        self.gap = max(self.gap, blank)

    def block(self, indent: int, block: _Block) -> None:
        """Lines that are laid out already."""
        self.end_line()
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines.append((min(indent, MOST_INDENT), block))

    def done(self) -> str:
        self.end_line()
        return "\n".join(line for item in self.lines for line in ([item] if isinstance(item, str) else (" " * item[0] + x for x in item[1].lines())))

    def shown(self) -> _Block:
        """All lines that are not blank."""
        self.end_line()
        out = _Block()
        for item in self.lines:
            if not isinstance(item, str):
                out.put(item[0], item[1], 0, item[1].height)
                out.text += item[1].text
            elif item.strip():
                out.add(item)
                out.text += len(item)
        return out


class _Open:
    """An open element."""

    __slots__ = ("tag", "unseen", "veiled", "pre", "number", "rows", "sink", "indent", "span")

    def __init__(self, tag: str, unseen: bool, veiled: bool, pre: bool, indent: int):
        self.tag, self.unseen, self.veiled, self.pre, self.indent = tag, unseen, veiled, pre, indent
        self.number, self.rows, self.sink, self.span = 0, None, None, (1, 1)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(source)} if source.strip(" /\n\t\r") else {}


def _number(s: str, most: int) -> int:
    return max(1, min(most, int(s))) if s.isdecimal() and len(s) < 9 else 1


def _grid(rows: list[list[tuple[_Block, int, int]]]) -> list[list[tuple[int, _Block, int]]]:
    """Rows of cells (block, columns, rows spanned) -> for each row, its cells as (column, block, columns spanned)."""
    out: list[list[tuple[int, _Block, int]]] = []
    spans: list[tuple[int, int, int]] = []  # (first column, column behind, rows left) covered from above, in order
    for row in rows:
        placed, at, above = [], 0, iter(spans)
        gap = next(above, None)
        new = []
        for block, columns, down in row:
            while gap and gap[0] <= at:
                at, gap = max(at, gap[1]), next(above, None)
            placed.append((at, block, columns))
            if down > 1 and len(spans) + len(new) < MOST_SPANNED:
                new.append((at, at + columns, down - 1))
            at += columns
        out.append(placed)
        spans = sorted([(lo, hi, n - 1) for lo, hi, n in spans if n > 1] + new)
    return out


def _aligned(rows: list[list[tuple[_Block, int, int]]], widest: int | None) -> _Block:
    """The table's lines: columns padded to their widest cell; cells one under the other where padding would outgrow the text."""
    grid = _grid(rows)
    widths: dict[int, int] = {}
    for row in grid:
        for at, block, columns in row:
            if columns == 1 and block.height and (widest is None or block.width <= widest):
                widths[at] = max(widths.get(at, 0), block.width)
    # a column without text has no width, however many columns a cell spans
    used = sorted(widths)
    ends = list(accumulate((widths[c] + 2 for c in used), initial=0))
    start = lambda at: ends[bisect_left(used, at)]
    text = sum(b.text for row in grid for _, b, _ in row)
    size = sum(b.size + start(at) * b.height for row in grid for at, b, _ in row)
    out = _Block(text)
    side_by_side = size <= MOST_PADDING * text + 200
    for row in grid:
        cells = [(start(at) if side_by_side else 0, b) for at, b, _ in row if b.height]
        heights = sorted((b.height for _, b in cells), reverse=True)
        both = heights[1] if len(heights) > 1 else 0  # so many lines have several cells
        if not side_by_side and both > 1:
            for _, b in cells:
                out.put(0, b, 0, b.height)
            continue
        texts = [b.lines(0, both) for _, b in cells]
        for _ in range(both):
            line = ""
            for (x, _), t in zip(cells, texts):
                if cell := next(t, ""):
                    line = (line + "  " if len(line) > x - 2 and line else line).ljust(x) + cell
            out.add(line.rstrip())
        for x, b in cells:
            if b.height > both:
                out.put(x, b, both, b.height)
    return out


class Page:
    """Lays out one page.

    ``places`` holds for each tag where it stands open in the stack, innermost last, so that no search goes through the stack.
    """

    def __init__(self, widest: int | None = WIDEST) -> None:
        self.widest = widest
        self.stack: list[_Open] = [_Open("html", False, False, False, 0)]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.sinks: list[_Sink] = [_Sink()]
        self.tables: list[_Open] = []

    def render(self, html: str) -> str:
        at = 0
        while at < len(html):
            m = _TOKEN.match(html, at)
            at = m.end()
            name = m[2] or m[4]
            if name:
                tag = name.lower()
                self._start(tag, m[3] or m[5] or "")
                if tag in RAW or tag in ESCAPED_RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                    stop = end.start() if end else len(html)
                    if tag in ("xmp", "textarea"):
                        raw = html[at:stop].removeprefix("\n")
                        self._text(raw, escaped=tag == "textarea")
                    at = stop
            elif m[1]:
                self._end(m[1].lower())
            elif not m[0].startswith("<") or m[0] == "<":
                self._text(m[0])
        while len(self.stack) > 1:
            self._close()
        return self.sinks[0].done()

    def _innermost(self, names) -> int:
        """The place of the innermost open element of these names, or -1."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def _text(self, s: str, escaped: bool = True) -> None:
        if self.stack[-1].tag == "head" and s.strip():
            self._close()
        top = self.stack[-1]
        if top.unseen or top.veiled or top.tag in ("table", "tr", *ROW_GROUPS) and not s.strip():
            return
        s = entities.unescape(s) if escaped else s
        (self.sinks[-1].exact if top.pre else self.sinks[-1].text)(s, top.indent)

    def _start(self, tag: str, source: str) -> None:
        if self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self._close()
        if tag in ("html", "body"):
            return
        if tag in IMPLIED:
            self._imply(*IMPLIED[tag])
        if tag in ENDS_P:
            self._imply({"p"}, SCOPE)
        if tag in CELLS and self.stack[-1].tag != "tr":
            self._start("tr", "")
        top = self.stack[-1]
        attributes = _attributes(source) if source else {}
        style = attributes.get("style", "")
        shown, seen = _DISPLAY.findall(style), _VISIBILITY.findall(style)
        unseen = top.unseen or tag in UNSEEN or "hidden" in attributes or bool(shown) and shown[-1].lower() == "none"
        veiled = seen[-1].lower() in ("hidden", "collapse") if seen and seen[-1].lower() != "inherit" else top.veiled
        sink = self.sinks[-1]
        if tag in VOID:
            if unseen:
                return
            if tag == "br":
                sink.end_line(force=True)
            elif tag == "hr":
                sink.margin(1)
            elif tag == "img" and attributes.get("alt") and not veiled:
                sink.text(attributes["alt"], top.indent)
            return
        new = _Open(tag, unseen, veiled, top.pre or tag in ("pre", "xmp", "textarea"), top.indent)
        in_list = self._innermost(LISTS)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(new)
        if unseen:
            return
        if tag in CELLS or tag == "caption":
            new.sink, new.indent, new.pre = _Sink(), 0, False
            self.sinks.append(new.sink)
            new.span = (_number(attributes.get("colspan", ""), MOST_SPAN), _number(attributes.get("rowspan", ""), MOST_SPAN))
        elif tag in BLOCK and tag != "tr":
            sink.margin(0 if in_list >= 0 and tag in LISTS else int(tag in SPACED))
        if tag == "table":
            new.rows = []
            self.tables.append(new)
        elif tag == "tr":
            if self.tables:
                self.tables[-1].rows.append([])
        elif tag in LISTS:
            start = attributes.get("start", "1")
            new.number = int(start) if tag == "ol" and start.isdecimal() and len(start) < 9 else int(tag == "ol")
        elif tag == "li":
            owner = self.stack[in_list] if in_list >= 0 else None
            mark = f"{owner.number}. " if owner and owner.tag == "ol" else "- "
            if owner and owner.tag == "ol":
                owner.number += 1
            if not veiled:
                sink.mark(mark, top.indent)
            new.indent = top.indent + len(mark)
        elif tag in ("dd", "blockquote"):
            new.indent = top.indent + 2

    def _imply(self, names, boundary) -> None:
        """Closes what the next tag ends: from the outermost open element of these names on that no boundary is in between."""
        least = self._innermost(boundary)
        while (at := self._innermost(names)) > max(least, 0):
            while len(self.stack) > at:
                self._close()

    def _end(self, tag: str) -> None:
        if tag == "p" and not self.places.get("p"):
            if not self.stack[-1].unseen:
                self.sinks[-1].margin(1)
            return
        if tag == "br":
            return self._start("br", "")
        at = self._innermost((tag,))
        if at < 1 or tag not in ("table", "tr", "thead", "tbody", "tfoot", "td", "th") and self._innermost(SCOPE) > at:
            return
        while len(self.stack) > at:
            self._close()

    def _close(self) -> None:
        e = self.stack.pop()
        self.places[e.tag].pop()
        if e.unseen:
            return
        if e.sink is not None:
            self.sinks.pop()
            block = e.sink.shown()
            if e.tag == "caption":
                self.sinks[-1].margin(0)
                if block.height:
                    self.sinks[-1].block(e.indent, block)
                self.sinks[-1].margin(0)
            elif self.tables and self.tables[-1].rows:
                self.tables[-1].rows[-1].append((block, *e.span))
            else:
                self.sinks[-1].text(" ".join(block.lines()) + " ", self.stack[-1].indent)
        elif e.rows is not None:
            self.tables.pop()
            sink, block = self.sinks[-1], _aligned(e.rows, self.widest)
            if block.height:
                sink.block(e.indent, block)
            sink.margin(1)
        elif e.tag == "li":
            self.sinks[-1].end_line()
        elif e.tag in BLOCK and e.tag != "tr":
            nested = e.tag in LISTS and self._innermost(LISTS) >= 0
            self.sinks[-1].margin(0 if nested else int(e.tag in SPACED))


def render(html: str | None, widest: int | None = WIDEST) -> str | None:
    """The visible text of a page."""
    return None if html is None else Page(widest).render(html)


def _render(widest: int | None):
    def run(batches):
        for batch in batches:
            text = [render(h, widest) for h in batch.column("html").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, "_text"])

    return run


def extract_text(pages: DataFrame, widest: int | None = WIDEST) -> DataFrame:
    """``pages`` with ``_text``, what ``html`` shows."""
    pages = pages.drop("_text")
    return pages.mapInArrow(_render(widest), StructType([*pages.schema.fields]).add("_text", "string"))
