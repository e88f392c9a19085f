"""Visible text of web pages, laid out: blocks on lines of their own, lists, aligned tables."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html import unescape
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.llm.common import schema_with

GAP = "  "           # between table cells
INDENT = " " * 300   # lines that begin with it are not indented further

# rules of the HTML standard that the layout needs
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes datalist "
                   "audio video canvas object".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp ul ol dl table figure hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address center fieldset form "
    "legend li dt dd details summary dialog figcaption tr td th caption thead tbody tfoot "
    "option optgroup menu dir search hgroup".split())
CLOSES_P = BLOCK - frozenset("html body option optgroup tr td th caption thead tbody tfoot".split())
# a start tag closes the open element on the left, if none of those on the right lies between
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "template"}),
    "td": ({"td", "th"}, {"tr", "table", "template"}), "th": ({"td", "th"}, {"tr", "table", "template"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table", "template"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table", "template"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table", "template"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
}
SECTIONS = frozenset("thead tbody tfoot".split())
# a start tag of a table's part closes all that is open in the table but these
PART_OF = {"tr": SECTIONS, "td": SECTIONS | {"tr"}, "th": SECTIONS | {"tr"},
           **dict.fromkeys("caption colgroup col thead tbody tfoot".split(), frozenset())}
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th body html template".split())
IN_HEAD = frozenset("base link meta script style title template noscript".split())

# a quote opens a value only behind the equals sign; elsewhere it is part of a name or value
_VALUE = r"[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+))?+"
_ATTRIBUTE = re.compile(r"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)(?:" + _VALUE + ")?+")
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^ \t\n\r\f/>]*+)(?P<rest>(?:[ \t\n\r\f/]++|"
    + _ATTRIBUTE.pattern + r")*+)(?:>|\Z)", re.DOTALL)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.DOTALL)
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?[0-9]+)")
_IMPORTANT = re.compile(r"\s*!\s*important$")


# values of ``visibility``; these take that of the element around
VISIBILITY = frozenset("visible hidden collapse initial inherit unset revert revert-layer".split())
AROUND = frozenset("inherit unset revert revert-layer".split())


def _declared(style: str) -> dict[str, str]:
    """Properties of a style attribute.  Of declarations of one property the last counts, one that
    is important before others."""
    chosen: dict[str, tuple[str, bool]] = {}
    for part in _COMMENT.sub(" ", style).lower().split(";"):
        name, _, value = (x.strip() for x in part.partition(":"))
        plain = _IMPORTANT.sub("", value)
        important = plain != value
        if name == "visibility" and plain not in VISIBILITY:
            continue
        if plain and (important or not chosen.get(name, ("", False))[1]):
            chosen[name] = plain, important
    return {name: value for name, (value, _) in chosen.items()}


def _hides(style: str) -> bool:
    """Whether a style attribute hides the text right inside its element."""
    declared = _declared(style)
    return (declared.get("display") == "none"
            or declared.get("visibility") in ("hidden", "collapse"))


@dataclass
class Element:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # elements and texts

    def visible(self) -> bool:
        """Whether the element is laid out; else all that is in it is hidden, too."""
        a = self.attributes
        return not (self.name in HIDDEN or "hidden" in a
                    or "style" in a and _declared(a["style"] or "").get("display") == "none"
                    or self.name == "dialog" and "open" not in a)

    def number(self, attribute: str, default: int | None = None) -> int | None:
        """Sign and digits at the begin of an attribute; the default without, or where browsers
        have no such number, as it has more than 32 bits."""
        found = _NUMBER.match(self.attributes.get(attribute) or "")
        value = int(found[1]) if found and len(found[1]) < 20 else None
        return default if value is None or not -2**31 <= value < 2**31 else value

    def span(self, attribute: str, most: int) -> int:
        return max(1, min(most, self.number(attribute, 1)))


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        found.setdefault(m[1].lower(), unescape(value))
    return found


def parse(html: str) -> Element:
    """The tree of a page.  End tags that the standard lets out are supplied; an end tag without
    an open element is dropped; elements that are open at the end are closed."""
    root = Element("html")
    open_: list[Element] = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements, by name

    def push(element: Element) -> None:
        places[element.name].append(len(open_))
        open_.append(element)

    def cut(depth: int) -> None:
        while len(open_) > depth:
            places[open_.pop().name].pop()

    def last(names: set[str] | frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places[n]), default=0)

    def close(names: set[str], until: set[str], innermost: bool = False) -> None:
        if not any(places[n] for n in names):
            return
        least = last(until)
        if innermost:
            depths = [last(names)]
        else:
            depths = [places[n][bisect_right(places[n], least)] for n in names
                      if places[n] and places[n][-1] > least]
        if depths and min(depths) > least:
            cut(min(depths))

    def part_of(names: frozenset[str]) -> None:
        if places["table"]:
            cut(last(names) + 1)

    def text(part: str) -> None:
        if part:
            if open_[-1].name == "head" and part.strip():
                cut(len(open_) - 1)
            open_[-1].children.append(unescape(part) if "&" in part else part)

    at = 0
    for m in iter(lambda: _MARKUP.search(html, at), None):
        text(html[at:m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if name == "br":
                open_[-1].children.append(Element("br"))
            else:  # what stands in a cell can't close what stands around the table
                close({name}, set() if name in TABLE_PARTS else {"td", "th", "table"}, True)
            continue
        element = Element(name, _attributes(m["rest"]) if m["rest"] else {})
        if name in ("html", "body") and (name == "html" or places["body"]):
            continue
        if open_[-1].name == "head" and name not in IN_HEAD:
            cut(len(open_) - 1)
        if name in CLOSES_P:
            close({"p"}, {"td", "th", "table", "button", "li", "div", "article", "section", "body"})
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        if name in PART_OF:
            part_of(PART_OF[name] | {"table", "template"})
        open_[-1].children.append(element)
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            stop = end.start() if end else len(html)
            body = html[at:stop]
            element.children.append(unescape(body) if name in ("textarea", "title") else body)
            at = end.end() if end else len(html)
        elif name == "form" and (open_[-1].name in SECTIONS or open_[-1].name in ("table", "tr")):
            pass  # stays empty, as its rows are the table's
        elif name not in VOID:
            push(element)
    text(html[at:])
    return root


class Block(NamedTuple):
    """Lines, and whether an empty line belongs before and behind them."""

    lines: list[str]
    before: bool = False
    behind: bool = False


class Page:
    """Lines of a block: running text is collapsed and flows, blocks begin new lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.space = False   # white space stands before the next word
        self.gap = False     # an empty line stands before the next line
        self.lead = False    # an empty line stands before the first line

    def text(self, part: str) -> None:
        words = _SPACE.split(part)
        if words[0] == "" and len(words) > 1:
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self.line += " " + body if self.space and self.line else body
            self.space = words[-1] == ""

    def end_line(self) -> None:
        if self.line:
            self.put([self.line])
        self.line, self.space = "", False

    def put(self, lines: list[str]) -> None:
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.lead |= self.gap and not self.lines
            self.gap = False
            if self.lines:
                self.lines += lines
            else:
                self.lines = lines

    def block(self, block: Block) -> None:
        self.end_line()
        if block.lines:
            self.gap |= block.before
            self.put(block.lines)
            self.gap |= block.behind

    def whole(self, spaced: bool = False) -> Block:
        self.end_line()
        return Block(self.lines, spaced or self.lead, spaced or self.gap)


# Elements may be nested as deep as a page is long, so the functions of the layout don't call
# each other: they yield the layout of a child, and get its result back.
Steps = Generator["Steps", Any, Any]


def _run(steps: Steps) -> Any:
    """The result of a layout function."""
    stack, result = [steps], None
    while stack:
        try:
            stack.append(stack[-1].send(result))
            result = None
        except StopIteration as end:
            stack.pop()
            result = end.value
    return result


def _flow(page: Page, element: Element) -> Steps:
    for child in element.children:
        if isinstance(child, str):
            page.text(child)
        elif child.name == "br":
            if page.line:
                page.end_line()
            elif page.lines:
                page.gap = True
        elif not child.visible():
            continue
        elif child.name in BLOCK or child.name == "textarea":
            page.block((yield _block(child)))
        else:
            yield _flow(page, child)


def _block(element: Element) -> Steps:
    """The lines of a block element."""
    if element.name == "table":
        return (yield _table(element))
    if element.name in ("ul", "ol", "menu", "dir"):
        return (yield _list(element))
    if element.name in ("pre", "textarea", "xmp"):
        lines = _verbatim(element).removeprefix("\n").expandtabs(8).split("\n")
        while lines and not lines[-1].strip():
            lines.pop()
        spaced = element.name in SPACED
        return Block([line.rstrip() for line in lines], spaced, spaced)
    if element.name == "details" and "open" not in element.attributes:
        shown = next((c for c in element.children if isinstance(c, Element) and c.name == "summary"), None)
        return (yield _block(shown)) if shown and shown.visible() else Block([])
    page = Page()
    yield _flow(page, element)
    block = page.whole(element.name in SPACED)
    if element.name in ("dd", "blockquote"):
        return block._replace(lines=_indented(block.lines))
    return block


def _indented(lines: list[str], by: str = "  ") -> list[str]:
    return [by + line if line and not line.startswith(INDENT) else line for line in lines]


def _verbatim(element: Element) -> str:
    parts, left = [], [iter(element.children)]
    while left:
        child = next(left[-1], None)
        if child is None:
            left.pop()
        elif isinstance(child, str):
            parts.append(child.replace("\r\n", "\n").replace("\r", "\n"))
        elif child.name == "br":
            parts.append("\n")
        elif child.visible():
            left.append(iter(child.children))
    return "".join(parts)


def _list(element: Element) -> Steps:
    """Items behind a dash or their number; nested lists are indented below their item."""
    page = Page()
    number = element.number("start", 1)
    for child in element.children:
        if isinstance(child, str):
            page.text(child)
        elif not child.visible():
            continue
        elif child.name == "li":
            number = child.number("value", number)
            mark = f"{number}. " if element.name == "ol" else "- "
            number += 1
            lines = [line for line in (yield _block(child)).lines if line]
            page.block(Block([*(mark + line for line in lines[:1]),
                              *_indented(lines[1:], " " * len(mark))]))
        elif child.name in BLOCK:
            page.block(Block(_indented((yield _block(child)).lines)))
        else:
            yield _flow(page, child)
    return page.whole(True)


def _parts(table: Element) -> tuple[list[Element], list[list[Element | str]]]:
    """Rows of a table, the head first and the foot last, where cells outside a row make one; and
    runs of what stands neither in a cell nor in a nested part: captions and stray content."""
    rows: dict[str, list[Element]] = {"thead": [], "tbody": [], "tfoot": []}
    stray: list[list[Element | str]] = [[]]

    def row(cells: Element) -> Element:
        kept = Element("tr")
        for child in cells.children:
            if isinstance(child, str) or child.name not in ("td", "th"):
                stray[-1].append(child)
            else:
                stray.append([])
                if child.visible():
                    kept.children.append(child)
        stray.append([])
        return kept

    def part(element: Element, section: str) -> None:
        loose = None  # row of cells that have none
        for child in element.children:
            if isinstance(child, str) or child.name not in PART_OF or child.name == "caption":
                stray[-1].append(child)
                continue
            stray.append([])
            if not child.visible():
                continue
            if child.name in SECTIONS or child.name == "colgroup":
                part(child, section if child.name == "colgroup" else child.name)
                stray.append([])
            elif child.name == "tr":
                rows[section].append(row(child))
            elif child.name in ("td", "th"):
                if loose is None:
                    loose = Element("tr")
                    rows[section].append(loose)
                loose.children.append(child)
                continue
            loose = None

    part(table, "tbody")
    return [r for section in rows.values() for r in section], stray


def _table(element: Element) -> Steps:
    """Captions and stray content, then the rows with cells padded to the width of their column.
    A cell may have several lines; it spans columns and rows as its attributes say."""
    page = Page()
    rows, stray = _parts(element)
    for run in stray:
        page.block((yield _block(Element("div", {}, run))))
    grid: list[dict[int, tuple[int, list[str]]]] = []
    held: dict[int, int] = {}  # rows for which a column is still taken from above
    for row in rows:
        cells: dict[int, tuple[int, list[str]]] = {}
        taken = {c for c, n in held.items() if n > 0}
        held = {c: n - 1 for c, n in held.items() if n > 1}
        column = 0
        for cell in row.children:
            while column in taken:
                column += 1
            span, down = cell.span("colspan", 1000), cell.span("rowspan", 65534)
            lines = (yield _block(cell)).lines
            cells[column] = span, [line for line in lines if line]
            for c in range(column, column + span):
                if down > 1:
                    held[c] = down - 1
            column += span
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, (span, lines) in cells.items():
            if span == 1 and lines:
                widths[column] = max(widths.get(column, 0), max(map(len, lines)))
    columns = sorted({c for cells in grid for c in cells} | set(widths))
    starts, at = {}, 0
    for c in columns:
        starts[c] = at
        if c in widths:
            at += widths[c] + len(GAP)
    for cells in grid:
        for i in range(max((len(lines) for _, lines in cells.values()), default=0)):
            line = ""
            for column in sorted(cells):
                lines = cells[column][1]
                if i < len(lines):
                    line = line.ljust(starts[column])
                    line += (GAP if line and not line.endswith(GAP) else "") + lines[i]
            page.put([line.rstrip()])
    return page.whole(True)


def _blank_invisible(root: Element) -> Element:
    """Text whose element is invisible becomes a space.  Elements take their visibility from the
    one around them unless they declare their own, so a part of a hidden one may show again."""
    left = [(root, True)]
    while left:
        element, shown = left.pop()
        own = None
        if "style" in element.attributes:
            own = _declared(element.attributes["style"] or "").get("visibility")
        if own is not None and own not in AROUND:
            shown = own not in ("hidden", "collapse")
        if not shown:
            element.children = [" " if isinstance(c, str) and c else c for c in element.children]
        left += [(c, shown) for c in element.children if isinstance(c, Element)]
    return root


def visible_text(html: str) -> str:
    """All visible text of a page, see ``extract``."""
    return "\n".join(_run(_block(_blank_invisible(parse(html)))).lines)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The columns of ``pages`` but ``html``, with the page's visible ``text``.

    The page is parsed to a tree, with implied end tags.  Elements that browsers don't show (head,
    scripts, templates, ``hidden``, ``display: none``, closed dialogs and details, ...) are left
    out with all that is in them; what ``visibility`` hides may hold parts that show again.  Lines
    that begin with INDENT are not indented further, no text of them is lost.  White space is collapsed except in preformatted text; blocks
    begin new lines, paragraphs, headings, lists and tables have an empty line around them; list
    items carry a dash or number; table cells are padded to their column's width.

    A null page has null text, an empty one empty text; pages without markup are one block.
    Repeated rows are rendered each; a column of ``pages`` named like the new one is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, text)]
    schema = schema_with(pages, kept, f"`{text}` string")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else visible_text(x) for x in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())],
                                             names=[*kept, text])

    return pages.select(*kept, F.col(html).alias("_html")).mapInArrow(render, schema)
