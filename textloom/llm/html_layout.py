"""Visible text of web pages, laid out.

A tree builder reads the markup with the rules that pages rely on: void elements, raw text elements,
start tags that end an open paragraph, list item, cell or row, rows that a table implies, end tags that
close what was left open, a head that ends with the first thing that does not belong into it. Elements that
a browser would not show are left out: the head and its content, scripts, styles, templates, hidden elements,
those styled away (a visible part of an invisible one is shown), closed choices, the body of closed details,
the options of a drop-down list but for the chosen one. Everything else is emitted, formulas and the text of
drawings too: blocks on lines of their own, paragraphs and headings set off by a blank line, list items with
their mark and depth, table cells in aligned columns, preformatted text as it is, other white space folded.

Time grows with the length of the source, whatever its markup: open elements are found by name, unfinished
quotations are searched for once, and neither building nor rendering recurses.

Defined results: null gives null; repeated rows give one result each; other columns of the table are not
read; text without markup is one block; unknown elements are inline; a tag that never ends is text if no
``>`` follows, else it ends the page as in browsers; a quotation that never ends is taken up to the next
space or ``>``. Layout alone has bounds, text is never lost: cells wider than ``PAD_MOST`` are not padded,
indents stop at ``INDENT_MOST``, and the cells of tables nested deeper than ``TABLES_MOST``, or that padding
would make more than ``PADDING_MOST`` times as long, get lines of their own.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

PAD_MOST, INDENT_MOST, TABLES_MOST, PADDING_MOST = 60, 80, 6, 20

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title meta link noscript iframe object embed audio video canvas datalist noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu dir".split())
ENDS_P = BLOCK - frozenset("body caption dd dt html legend option optgroup select".split())
SCOPE = frozenset("table td th caption html template button object marquee applet".split())
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
SECTIONS = frozenset("thead tbody tfoot".split())
# a part of a table ends everything up to the nearest of these
TABLE_PARTS = {tag: frozenset({"table"}) for tag in ("caption", "colgroup", *SECTIONS)}
TABLE_PARTS |= {"col": frozenset({"table", "colgroup"}), "tr": SECTIONS | {"table"}, "td": SECTIONS | {"table", "tr"}, "th": SECTIONS | {"table", "tr"}}
# not drawn within a drawing, not shown within a formula
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())
UNWRITTEN = frozenset("annotation annotation-xml".split())
# a start tag ends the nearest of these, unless one of the others stands in between
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
}

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
GAP, NAME, EQUALS, BARE = (re.compile(x) for x in (r"[\s/]*+", r"=?[^\s/>=]*+", r"\s*+=\s*+", r"[^\s>]*+"))
GONE = re.compile(r"display\s*:\s*none", re.IGNORECASE)
SIGHT = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []


class Attributes:
    """Reads what stands between a tag's name and its end. Quotes count directly behind ``=`` only."""

    def __init__(self, source: str):
        self.source = source
        # no quotation begun at or behind these places ends
        self.lost = {"'": len(source), '"': len(source)}

    def read(self, at: int) -> tuple[dict[str, str], bool, int] | None:
        """Attributes, whether the tag ends itself, and the place behind it; None if it never ends."""
        source, found = self.source, {}
        while True:
            gap = GAP.match(source, at)
            at = gap.end()
            if at == len(source):
                return None
            if source[at] == ">":
                return found, gap[0].endswith("/"), at + 1
            name = NAME.match(source, at)
            at, value = name.end(), ""
            equals = EQUALS.match(source, at)
            if equals:
                value, at = self.value(equals.end())
            found.setdefault(name[0].lower(), unescape(value))

    def value(self, at: int) -> tuple[str, int]:
        quote = self.source[at : at + 1]
        if quote in ("'", '"') and at < self.lost[quote]:
            stop = self.source.find(quote, at + 1)
            if stop >= 0:
                return self.source[at + 1 : stop], stop + 1
            self.lost[quote] = at
        bare = BARE.match(self.source, at)
        return bare[0], bare.end()


class Builder:
    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        # places of the open elements by name
        self.names: dict[str, list[int]] = {"html": [0]}

    def nearest(self, tags: set[str] | frozenset[str]) -> int:
        """Place of the innermost open element of ``tags``, or 0."""
        return max((self.names[t][-1] for t in tags if self.names.get(t)), default=0)

    def close(self, wanted: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> bool:
        """End the nearest open element of ``wanted`` and all inside it, if no ``stop`` lies before it."""
        i = self.nearest(wanted)
        if not i or i < self.nearest(stop):
            return False
        self.cut(i)
        return True

    def cut(self, i: int) -> None:
        for node in self.open[i:]:
            self.names[node.tag].pop()
        del self.open[i:]

    def leave(self, tag: str | None) -> None:
        """End a head or a group of columns that ``tag``, or text if it is None, does not belong into."""
        if self.open[-1].tag == "head" and tag not in HEAD:
            self.cut(len(self.open) - 1)
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self.cut(len(self.open) - 1)

    def back_to_table(self, wanted: frozenset[str]) -> None:
        """End what is open inside the nearest of ``wanted``, be it in a cell or out of place."""
        i = self.nearest(wanted)
        if i and i > self.nearest({"template"}):
            self.cut(i + 1)

    def foreign(self) -> bool:
        return bool(self.names.get("svg") or self.names.get("math"))

    def start(self, tag: str, attrs: dict[str, str], empty: bool = False) -> None:
        if tag in ("html", "body") and self.names.get(tag):
            return
        if tag == "body":
            self.close({"head"}, frozenset())
        self.leave(tag)
        if self.foreign():
            if tag in BLOCK:
                # pages go on behind a drawing or formula that was left open
                self.close({"svg", "math"}, {"foreignobject", "annotation-xml", "table"})
            elif (tag in UNDRAWN and self.names.get("svg")) or (tag in UNWRITTEN and self.names.get("math")):
                attrs = attrs | {"hidden": ""}
            elif tag == "text":
                self.text(" ")
        if tag in TABLE_PARTS and self.names.get("table"):
            self.back_to_table(TABLE_PARTS[tag])
        if tag == "form" and (self.open[-1].tag in SECTIONS or self.open[-1].tag in ("table", "tr")):
            return  # holds no rows or cells: they belong to the table
        if tag in ENDS_P:
            self.close({"p"}, SCOPE)
        if tag in ENDS:
            self.close(*ENDS[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.start("tr", {})
        if tag in ("tr", "thead", "tbody", "tfoot"):
            self.close({"td", "th"}, {"table"})
            self.close({"tr"}, {"table"})
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID and not empty:
            self.names.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not self.names.get("p"):
            self.start("p", {})
            self.close({"p"}, frozenset())
        elif tag not in ("html", "body"):
            self.close({tag}, {"table"} if tag not in ("table", "caption") else frozenset())

    def text(self, value: str) -> None:
        if value:
            if value.strip(" \t\n\r\f"):
                self.leave(None)
            self.open[-1].children.append(value)


def build(source: str) -> Node:
    builder, at, n = Builder(), 0, len(source)
    reader, last = Attributes(source), source.rfind(">")
    while at < n:
        m = TOKEN.search(source, at)
        if m is None or (m[2] and m.start() > last):
            builder.text(unescape(source[at:]))
            break
        builder.text(unescape(source[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag, inside = m[2].lower(), reader.read(at)
        if inside is None:
            break
        attrs, empty, at = inside
        if m[1]:
            builder.end(tag)
            continue
        # a tag that ends itself does so in drawings and formulas only
        empty = empty and (tag in ("svg", "math") or builder.foreign())
        builder.start(tag, attrs, empty)
        if tag in RAW and not empty:
            # everything up to the end tag is text
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(source, at)
            body = source[at : close.start() if close else n]
            builder.text(unescape(body) if tag in ("title", "textarea") else body)
            at = close.end() if close else n
            builder.end(tag)
    return builder.root


def shown(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    return not (node.tag == "dialog" and "open" not in a) and not GONE.search(a.get("style", ""))


def in_sight(node: Node, around: bool) -> bool:
    """Whether the text of ``node`` can be seen; what its style does not say is taken from ``around``."""
    said = SIGHT.findall(node.attrs.get("style", ""))
    return said[-1].lower() == "visible" if said else around


def chosen(select: Node) -> list[Node | str]:
    """The option that a drop-down list shows, or all parts of a list that is shown whole."""
    size = select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isdigit() and size.strip("0") not in ("", "1")):
        return select.children
    options, ahead = [], [c for c in reversed(select.children) if isinstance(c, Node)]
    while ahead:
        node = ahead.pop()
        if node.tag == "option" and shown(node):
            options.append(node)
        else:
            ahead += [c for c in reversed(node.children) if isinstance(c, Node)]
    picked = [o for o in options if "selected" in o.attrs][-1:]
    return picked or [o for o in options if "disabled" not in o.attrs][:1]


def parts_of(node: Node) -> list[Node | str]:
    if node.tag == "select":
        return chosen(node)
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return node.children


class Sheet:
    """Lines of text: spaces are folded, and wanted line breaks are written when text follows."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.space, self.fresh = 0, False, True
        self.indent = ""
        self.tables = 0  # open around this sheet

    def block(self, breaks: int) -> None:
        self.breaks, self.space = max(self.breaks, breaks), False

    def _begin(self) -> None:
        if self.breaks:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            self.fresh = True
        self.breaks = 0
        if self.fresh:
            self.parts.append(self.indent)
            self.space = False
        self.fresh = False

    def words(self, value: str) -> None:
        folded = SPACE.sub(" ", value)
        bare = folded.strip(" ")
        if not bare:
            self.space |= bool(folded)
            return
        lead = folded[0] == " "
        was_fresh = self.fresh or bool(self.breaks) or not self.parts
        self.space |= lead
        pending = self.space
        self._begin()
        if pending and not was_fresh:
            self.parts.append(" ")
        self.parts.append(bare)
        self.space = folded[-1] == " "

    def raw(self, value: str) -> None:
        for i, line in enumerate(value.split("\n")):
            if i:
                self.line()
            if line:
                self._begin()
                self.parts.append(line)

    def mark(self, value: str) -> None:
        self._begin()
        self.parts.append(value)
        self.fresh, self.space = False, False

    def line(self) -> None:
        """A line break that counts even after another one."""
        if self.parts or self.breaks:
            self.breaks += 1
        self.space = False

    def text(self) -> str:
        return "".join(self.parts)


# a step of rendering yields the steps inside it, which ``finish`` takes first
Steps = Generator["Steps", None, None]


def finish(steps: Steps) -> None:
    """Run nested steps without recursion, so that no depth of markup is too deep."""
    waiting = [steps]
    while waiting:
        inner = next(waiting[-1], None)
        if inner is None:
            waiting.pop()
        else:
            waiting.append(inner)


def deeper(indent: str, by: str) -> str:
    return (indent + by)[:INDENT_MOST]


def render(node: Node, sheet: Sheet, depth: int = 0, pre: bool = False, seen: bool = True) -> Steps:
    tag = node.tag
    seen = in_sight(node, seen)
    if tag == "br":
        sheet.line()
        return
    if tag == "img" and node.attrs.get("alt"):
        if seen:
            sheet.words(node.attrs["alt"])
        return
    if tag == "hr":
        sheet.block(2)
        return
    if tag == "table":
        yield table(node, sheet, seen)
        return
    if tag == "svg":
        sheet.words(" ")
    lists = tag in ("ul", "ol", "menu", "dir")
    breaks = 0
    if tag in BLOCK:
        breaks = 2 if tag in SPACED and not (lists and depth) else 1
        sheet.block(breaks)
    outer = sheet.indent
    number = 0
    if lists or tag == "dl":
        with_number = tag == "ol"
        start = node.attrs.get("start", "1")
        number = int(start) if start.lstrip("-").isdigit() and len(start) < 9 else 1
    if tag == "blockquote" or tag == "dd":
        sheet.indent = deeper(outer, "  ")
    pre = pre or tag in ("pre", "textarea", "xmp")
    for child in parts_of(node):
        if isinstance(child, str):
            if seen:
                sheet.raw(child) if pre else sheet.words(child)
        elif shown(child):
            if lists and child.tag == "li":
                sheet.block(1)
                mark = f"{number}. " if with_number else "- "
                number += 1
                yield item(child, sheet, deeper("", "  " * min(depth, INDENT_MOST)) + mark, outer, depth + 1, pre, in_sight(child, seen))
            else:
                yield render(child, sheet, depth, pre, seen)
    sheet.indent = outer
    if breaks:
        sheet.block(breaks)
    elif tag == "svg":
        sheet.words(" ")


def item(node: Node, sheet: Sheet, mark: str, outer: str, depth: int, pre: bool, seen: bool) -> Steps:
    """A list item: its mark, and its further lines below the text of the first."""
    if seen:
        sheet.mark(mark)
    sheet.indent = deeper(outer, " " * len(mark))
    inner = Node("span", {})
    inner.children = node.children
    before = len(sheet.parts)
    yield render(inner, sheet, depth, pre, seen)
    # a block right behind the mark stays on the mark's line
    if seen and len(sheet.parts) > before and sheet.parts[before].strip("\n") == "" and sheet.parts[before]:
        sheet.parts[before] = ""
        if len(sheet.parts) > before + 1:
            sheet.parts[before + 1] = sheet.parts[before + 1].lstrip(" ")
    sheet.indent = outer
    sheet.block(1)


def rows_of(node: Node) -> Iterator[tuple[Node, Node]]:
    """Each row with the section, or table, that holds it."""
    for child in node.children:
        if isinstance(child, Node) and shown(child):
            if child.tag == "tr":
                yield node, child
            elif child.tag in SECTIONS:
                yield from rows_of(child)


def span(cell: Node | str, name: str, most: int) -> int:
    said = cell.attrs.get(name, "1").strip() if isinstance(cell, Node) else "1"
    return min(int(said), most) if said.isdigit() and len(said) < 6 else 1


def besides_rows(node: Node) -> Iterator[Node | str]:
    """What a table and its sections hold besides rows."""
    for child in node.children:
        if isinstance(child, str):
            yield child
        elif child.tag not in ("tr", "col") and shown(child):
            if child.tag in SECTIONS or child.tag == "colgroup":
                yield from besides_rows(child)
            else:
                yield child


def table(node: Node, sheet: Sheet, seen: bool) -> Steps:
    """Rows as lines, cells padded to the width of their column."""
    outer = sheet.indent
    sheet.block(2)
    for child in besides_rows(node):
        # captions, and what does not belong into a table, stand before it
        if isinstance(child, str):
            if seen:
                sheet.words(child)
        else:
            yield render(child, sheet, seen=seen)
            sheet.block(1)
    deep = sheet.tables >= TABLES_MOST
    grid: list[list[list[str]]] = []
    held: dict[int, int] = {}  # rows that a cell above still takes of a column
    section = None
    for home, row in rows_of(node):
        if home is not section:
            section, held = home, {}
        row_seen = in_sight(row, in_sight(home, seen) if home is not node else seen)
        cells: list[list[str]] = []
        below: dict[int, int] = {}
        for cell in row.children:
            if isinstance(cell, str) and not (row_seen and cell.strip()) or isinstance(cell, Node) and not shown(cell):
                continue
            if deep:
                sheet.block(1)
                if isinstance(cell, str):
                    sheet.words(cell)
                else:
                    yield render(cell, sheet, seen=row_seen)
                continue
            while held.get(len(cells)):
                cells.append([""])
            inner = Sheet()
            inner.tables = sheet.tables + 1
            if isinstance(cell, str):
                inner.words(cell)
            else:
                yield render(cell, inner, seen=row_seen)
            columns, rows = span(cell, "colspan", 50) or 1, span(cell, "rowspan", 65_534) or 65_534
            if rows > 1:
                below |= {c: rows for c in range(len(cells), len(cells) + columns)}
            cells.append([line for line in inner.text().split("\n") if line.strip()] or [""])
            cells += [[""]] * (columns - 1)
        held = {c: left - 1 for c, left in (held | below).items() if left > 1}
        grid.append(cells)
    widths: list[int] = []
    for cells in grid:
        widths += [0] * (len(cells) - len(widths))
        for i, lines in enumerate(cells):
            widths[i] = max(widths[i], max(map(len, lines)))
    widths = [min(w, PAD_MOST) for w in widths]
    sizes = sum(len(line) + 1 for cells in grid for lines in cells for line in lines)
    padded = sum(max(map(len, cells), default=0) * (sum(widths[: len(cells)]) + 2 * len(cells)) for cells in grid)
    aligned = padded <= PADDING_MOST * sizes + 10_000
    for cells in grid:
        if aligned:
            tall = range(max(map(len, cells), default=0))
            rows_out = ["  ".join((x[i] if i < len(x) else "").ljust(w) for x, w in zip(cells, widths)).rstrip() for i in tall]
        else:
            rows_out = [line for lines in cells for line in lines]
        for whole in rows_out:
            if whole:
                sheet.block(1)
                sheet.raw(whole)
    sheet.indent = outer
    sheet.block(2)


def extract(source: str | None) -> str | None:
    if source is None:
        return None
    sheet = Sheet()
    finish(render(build(source), sheet))
    return sheet.text()


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, text) for each row of ``pages`` (page_id, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(source) for source in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    return pages.select("page_id", "html").mapInArrow(run, "page_id bigint, text string")
