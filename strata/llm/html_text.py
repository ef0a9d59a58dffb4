"""Visible text of HTML pages, laid out: block spacing, lists, aligned table cells.

A tokenizer feeds a tree builder that keeps the stack of open elements, closes what the standard
closes by implication and reports openings, closings and text; the layout listens to it. Nothing
recurses, so depth is not limited.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "head script style title template noscript noembed noframes iframe object audio video canvas datalist".split()
)
#: In svg and math: what is not shown, what shows the text in it, and the tags that end both.
FOREIGN = frozenset(("svg", "math"))
UNDRAWN = frozenset(
    "desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter annotation annotation-xml".split()
)
DRAWN = frozenset(("text", "foreignobject"))
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul dd dt".split()
)
BLOCKS = CLOSES_P | frozenset("html body caption legend optgroup option tr tbody thead tfoot td th".split())
#: Blocks with a blank line around them.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu dir table figure hr".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot", "caption"))
#: By the tag that opens: which open elements it ends, and at which element the search for them stops.
ENDS = {
    "li": (frozenset(("li",)), LISTS | {"table"}),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "td": (CELLS, frozenset(("tr", "table"))),
    "th": (CELLS, frozenset(("tr", "table"))),
    "tr": (CELLS | {"tr", "caption"}, frozenset(("table",))),
} | {name: (CELLS | SECTIONS | {"tr"}, frozenset(("table",))) for name in SECTIONS}
P_SCOPE = CELLS | frozenset(("caption", "table", "button"))

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: A slash that ends an unquoted value closes nothing.
IN_VALUE = re.compile(r"=\s*[^\s\"'>]+/\Z")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("html head base link meta title style script noscript template".split())
#: Characters at which lines of a cell are wrapped, and beyond which a table's columns are not aligned.
CELL, TABLE = 80, 400
SPACES = re.compile(r"[ \t\n\f\r]+")


def attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if source.strip(" \t\r\n\f/"):
        for name, *values in ATTRIBUTE.findall(source):
            found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def hidden(name: str, attrs: dict[str, str]) -> bool:
    if name in UNSEEN or name == "dialog" and "open" not in attrs:
        return True
    return bool(attrs) and ("hidden" in attrs or NO_DISPLAY.search(attrs.get("style", "")) is not None)


def number(text: str, most: int) -> int | None:
    return int(text) if text.isdecimal() and len(text) <= len(str(most)) and int(text) <= most else None


class Page:
    """Text as it grows: pending line breaks and spaces become real when something follows them."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks = 0
        self.space = False
        self.indent = ""
        self.marker = ""

    def gap(self, lines: int) -> None:
        if self.parts:
            self.breaks = max(self.breaks, lines)
        self.space = False

    def put(self, text: str) -> None:
        if self.breaks or not self.parts:
            self.parts.append("\n" * self.breaks + self.indent + self.marker)
            self.marker = ""
        elif self.space:
            self.parts.append(" ")
        self.parts.append(text)
        self.breaks, self.space = 0, False

    def flow(self, text: str) -> None:
        """Text whose white space collapses."""
        plain = SPACES.sub(" ", text)
        if inner := plain.strip(" "):
            self.space = self.space or plain[0] == " "
            self.put(inner)
            self.space = plain[-1] == " "
        else:
            self.space = self.space or bool(plain)

    def exact(self, text: str) -> None:
        """Text whose white space stays."""
        for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.breaks += bool(self.parts)
                self.space = False
            if line:
                self.put(line)

    def text(self) -> str:
        return "\n".join(x.rstrip(" ") for x in "".join(self.parts).split("\n"))


class Layout:
    """Listens to the tree builder. Each table cell is a page of its own until its table ends."""

    def __init__(self) -> None:
        self.pages = [Page()]
        self.lists: list[list] = []
        self.tables: list[list[list[Cell]]] = []
        self.spans: list[tuple[int, int]] = []
        #: Of each open element that is seen: whether its text shows, and whether it is a closed
        #: details element that still waits for its summary (1) or has had it (2).
        self.state: list[list] = [[True, 0]]
        self.unseen = 0
        self.pre = 0
        #: Open svg and math elements, and what shows text in them.
        self.foreign: list[str] = []

    @property
    def page(self) -> Page:
        return self.pages[-1]

    def open(self, name: str, attrs: dict[str, str]) -> None:
        shows, folded = self.state[-1]
        if self.unseen or hidden(name, attrs) or self.foreign and name in UNDRAWN or folded and (folded == 2 or name != "summary"):
            self.unseen += name not in VOID
            return
        if folded:
            self.state[-1][1] = 2
        if name not in VOID:
            own = VISIBILITY.search(attrs["style"]) if "style" in attrs else None
            shows = own[1].lower() == "visible" if own else shows
            self.state.append([shows, int(name == "details" and "open" not in attrs)])
        if name in FOREIGN or self.foreign and name in DRAWN:
            self.foreign.append(name)
            if name in DRAWN:
                self.page.flow(" ")
        elif name == "br":
            self.page.breaks += bool(self.page.parts)
            self.page.space = False
        elif name == "table":
            self.page.gap(2)
            self.tables.append([])
        elif name == "tr":
            self.tables[-1].append([])
        elif name in CELLS:
            if not self.tables[-1]:
                self.tables[-1].append([])
            down = number(attrs.get("rowspan", ""), 65534)
            self.spans.append((number(attrs.get("colspan", ""), 1000) or 1, 1 if down is None else down or 65534))
            self.pages.append(Page())
        elif name in BLOCKS:
            self.page.gap(2 if name in SPACED and not (name in LISTS and self.lists) else 1)
            if name in LISTS:
                first = number(attrs.get("start", ""), 10**9)
                self.lists.append([name, 1 if first is None else first, self.page.indent])
            elif name == "li":
                self.item(number(attrs.get("value", ""), 10**9))
            elif name == "pre":
                self.pre += 1

    def item(self, value: int | None) -> None:
        if self.lists and value is not None:
            self.lists[-1][1] = value
        ordered = self.lists and self.lists[-1][0] == "ol"
        self.page.indent = self.lists[-1][2] if self.lists else ""
        self.page.marker = f"{self.lists[-1][1]}. " if ordered else "- "
        if ordered:
            self.lists[-1][1] += 1

    def indent_rest(self) -> None:
        """Lines of an item after its first, and lists in it, stand under its text."""
        if self.lists and not self.page.marker:
            self.page.indent = self.lists[-1][2] + "  "

    def close(self, name: str) -> None:
        if self.unseen:
            self.unseen -= 1
            return
        self.state.pop()
        if name in FOREIGN or self.foreign and name in DRAWN:
            self.foreign.pop()
            if name in DRAWN:
                self.page.flow(" ")
        elif name == "table":
            rows = self.tables.pop()
            for line in aligned(rows):
                self.page.gap(1)
                if line:
                    self.page.put(line)
            self.page.gap(2)
        elif name in CELLS:
            cell = self.pages.pop().text()
            self.tables[-1][-1].append(Cell(cell.split("\n"), *self.spans.pop()))
        elif name in BLOCKS:
            if name == "li":
                self.page.marker = ""
            elif name == "pre":
                self.pre -= 1
            if name in LISTS:
                self.page.indent = self.lists.pop()[2]
            self.page.gap(2 if name in SPACED and not (name in LISTS and self.lists) else 1)

    def text(self, text: str) -> None:
        if not self.unseen and self.state[-1] == [True, 0] and not (self.foreign and self.foreign[-1] == "svg"):
            (self.page.exact if self.pre else self.page.flow)(text)
            self.indent_rest()


def wrapped(lines: list[str]) -> list[str]:
    """Lines cut at spaces so that none is longer than CELL, but for longer words."""
    out = []
    for line in lines:
        start = 0
        while len(line) - start > CELL:
            cut = line.rfind(" ", start + 1, start + CELL + 1)
            cut = cut if cut > 0 else line.find(" ", start + CELL)
            if cut < 0:
                break
            out.append(line[start:cut])
            start = cut + 1
        out.append(line[start:])
    return out


@dataclass
class Cell:
    lines: list[str]
    across: int
    down: int


def in_columns(rows: list[list[Cell]]) -> list[list[tuple[int, Cell]]]:
    """Each row's cells with their columns, past those that cells of rows above reach down into."""
    taken: dict[int, int] = {}
    out = []
    for row in rows:
        at, placed = 0, []
        for cell in row:
            while taken.get(at, 0):
                at += 1
            placed.append((at, cell))
            at += cell.across
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        for at, cell in placed:
            if cell.down > 1:
                # What a cell over very many columns reaches into counts as far as there are cells.
                taken.update(dict.fromkeys(range(at, at + min(cell.across, len(row))), cell.down - 1))
        out.append(placed)
    return out


def aligned(rows: list[list[Cell]]) -> Iterator[str]:
    """Lines of a table: each column as wide as its widest cell, cells of several lines side by side,
    longer lines wrapped. A cell over several columns takes their room and widens none. In a table
    that is too wide for that, cells follow one another."""
    widths: dict[int, int] = {}
    placed = in_columns(rows)
    for row in placed:
        for at, cell in row:
            cell.lines = wrapped(cell.lines)
            own = max(map(len, cell.lines)) if cell.across == 1 else 0
            widths[at] = max(widths.get(at, 0), own)
    columns = sorted(widths)
    total = sum(widths.values()) + 3 * len(columns)
    if total > TABLE:
        for row in placed:
            yield " | ".join(" ".join(cell.lines) for _, cell in row).rstrip(" ")
        return
    # Where each column begins, for those that some cell begins in.
    begins, room = {}, 0
    for c in columns:
        begins[c] = room
        room += widths[c] + 3
    for row in placed:
        for k in range(max((len(cell.lines) for _, cell in row), default=0)):
            line, reached = "", 0
            for at, cell in row:
                # Columns before it that cells from above reach into are empty here.
                for c in columns[bisect_left(columns, reached) : bisect_right(columns, at)]:
                    if begins[c]:
                        line = line.ljust(begins[c] - 3) + " | "
                line += cell.lines[k] if k < len(cell.lines) else ""
                reached = at + cell.across
            yield line.rstrip(" ")


class Tree:
    """The stack of open elements, and the places of each name in it."""

    def __init__(self, layout: Layout) -> None:
        self.layout = layout
        self.stack: list[str] = []
        self.places: defaultdict[str, list[int]] = defaultdict(list)

    def last(self, names: frozenset[str]) -> int:
        """The place of the innermost open element of some names, -1 if there is none."""
        return max((own[-1] for n in names if (own := self.places[n])), default=-1)

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            name = self.stack.pop()
            self.places[name].pop()
            self.layout.close(name)

    def end(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Ends the outermost open element of `names` this side of `scope`, with all in it."""
        stop = self.last(scope)
        found = [own[k] for n in names if (k := bisect_right(own := self.places[n], stop)) < len(own)]
        if found:
            self.pop_to(min(found))

    def foreign(self) -> int | None:
        """The depth of the svg or math element whose content is read now, None in HTML."""
        depth = self.last(FOREIGN)
        return depth if depth > self.last(HTML_INSIDE) else None

    def text(self, text: str) -> None:
        if text:
            if self.stack and self.stack[-1] == "head" and not text.isspace():
                self.pop_to(len(self.stack) - 1)
            self.layout.text(text)

    def start(self, name: str, attrs: dict[str, str]) -> None:
        if self.stack and self.stack[-1] == "head" and name not in IN_HEAD:
            self.pop_to(len(self.stack) - 1)
        if name == "head" and self.stack not in ([], ["html"]):
            return
        if name in BREAKS_OUT and (depth := self.foreign()) is not None:
            self.pop_to(depth)
        if name in CELLS or name == "tr" or name in SECTIONS:
            if not self.places["table"]:
                return self.layout.text(" ")
        if name in ENDS:
            self.end(*ENDS[name])
        if name in CLOSES_P and self.places["p"]:
            self.end(frozenset(("p",)), P_SCOPE)
        if name in CELLS and self.stack[-1] != "tr":
            self.start("tr", {})
        if name not in VOID:
            self.places[name].append(len(self.stack))
            self.stack.append(name)
        self.layout.open(name, attrs)

    def finish(self, name: str) -> None:
        if name == "br":
            return self.start("br", {})
        if name == "p" and not self.places["p"]:
            self.start("p", {})
        if self.places[name]:
            # A cell keeps what is open outside it, unless its own table or row ends.
            outer = name in CELLS | SECTIONS | {"table", "tr", "body", "html"}
            depth = self.places[name][-1]
            if outer or self.last(CELLS) < depth:
                self.pop_to(depth)
        return None


def visible_text(page: str) -> str:
    """The visible text of one page."""
    tree = Tree(layout := Layout())
    at = 0
    while token := TOKEN.search(page, at):
        if token.start() > at:
            tree.text(html.unescape(page[at : token.start()]))
        at = token.end()
        if not token["name"]:
            if token[0].startswith("<![CDATA[") and tree.foreign() is not None:
                tree.text(token[0][9:].removesuffix("]]>"))
            continue
        name = token["name"].lower()
        if token["end"]:
            tree.finish(name)
            continue
        closed = token["attrs"].endswith("/") and not IN_VALUE.search(token["attrs"])
        closed = closed and (name in FOREIGN or name not in BREAKS_OUT and tree.foreign() is not None)
        tree.start(name, attributes(token["attrs"]) if token["attrs"] else {})
        if closed:
            if name not in VOID:
                tree.finish(name)
            continue
        if name == "pre" and page.startswith(("\n", "\r\n"), at):
            at = page.index("\n", at) + 1
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            stop = close.start() if close else len(page)
            if name not in UNSEEN:
                tree.text(html.unescape(page[at:stop]))
            at = stop
    tree.text(html.unescape(page[at:]))
    tree.pop_to(0)
    return layout.page.text()


def extract(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """For each page its key and `text`; a NULL page has a NULL text, one without text an empty one.
    Map-only, and a row for each given row.

    Style sheets are not read, only `hidden` and `style` of an element. Lines of table cells wrap at
    CELL characters, and a table wider than TABLE has its cells one after the other, so that a text
    is never much longer than its page. A reversed list counts upwards.
    """
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 500) for k in range(0, batch.num_rows, 500)):
                texts = [None if p is None else visible_text(p) for p in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["key", "text"])

    given = pages.select(F.col(key).alias("key"), F.col(source).alias("source"))
    return map_batches(given, run, f"key {kind}, text string").withColumnRenamed("key", key)
