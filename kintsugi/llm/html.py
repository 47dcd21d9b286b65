"""HTML to text as a reader sees it: a tree builder with implied tags, then layout.

The builder reads tags in order, closes elements whose end is implied (a ``p``
before a block, an ``li`` before the next, cells and rows of tables, a ``head``
before the first thing that does not belong there) and opens those that are missing (a row around a stray cell).  Visibility rules drop what
a browser does not show.  Layout keeps blocks apart by line ends or blank lines,
marks list items and indents nested lists, keeps preformatted text as it is, and
sets table cells in aligned columns.  Work is linear in the page's length.

Defined results: a null or empty page gives the empty text.  A tag that never
ends is dropped with the rest of the page, as browsers do.  Pages of any length
and nesting are rendered whole, without recursion.  Repeated rows get equal
results.  An input column with the output's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import text_of

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_UNQUOTED_END = re.compile(r"""=\s*+[^\s"'>]++\s*+$""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not parsed, up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose content is not shown.
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes object video audio canvas "
                   "datalist rp map annotation annotation-xml".split())
#: In an svg image only text elements and embedded pages show text, outside of these.
SVG_UNSEEN = frozenset("defs symbol clippath mask pattern marker lineargradient radialgradient filter desc metadata".split())
#: Elements in svg and math whose content is parsed as in a page, and start tags that end svg and math.
EMBEDDING = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
                     "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Any other tag, and text, ends an open head.
HEAD_CONTENT = frozenset("title meta link script style base basefont bgsound template noscript noframes head html".split())
#: Blocks with a blank line around them, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset".split())
LINED = frozenset("address article aside body center dd details dialog dir div dt footer form header hgroup hr html "
                  "legend li main menu nav option optgroup search section summary caption figcaption tr".split())
LISTS = frozenset("ul ol menu dir".split())
#: A start tag closes these open elements, looking up no further than the given ones.
_TABLE_PARTS = ("table",)
IMPLIED_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "td", "th", "table")),
    "dt": (("dt", "dd"), ("dl", "td", "th", "table")), "dd": (("dt", "dd"), ("dl", "td", "th", "table")),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th", "caption"), _TABLE_PARTS), "th": (("td", "th", "caption"), _TABLE_PARTS),
    "tr": (("td", "th", "tr", "caption"), _TABLE_PARTS),
    "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), _TABLE_PARTS),
    "thead": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), _TABLE_PARTS),
    "tfoot": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), _TABLE_PARTS),
    "rt": (("rt", "rp"), ("ruby",)), "rp": (("rt", "rp"), ("ruby",)),
    "body": (("head",), ()),
}
#: Columns grow to this many characters; longer cells stand out of theirs.
COLUMN_WIDTH = 40


class Flow:
    """Text of one formatting context: the page, or one table cell."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks = 0
        self.blank = False
        self.indent = 0

    def block(self, breaks: int) -> None:
        if self.out:
            self.breaks = max(self.breaks, breaks)
        self.blank = False

    def line_end(self) -> None:
        if self.out:
            self.breaks += 1
        self.blank = False

    def word(self, text: str) -> None:
        if self.breaks or not self.out:
            self.out.append("\n" * self.breaks + "  " * self.indent)
        elif self.blank:
            self.out.append(" ")
        self.breaks, self.blank = 0, False
        self.out.append(text)

    def inline(self, text: str) -> None:
        words = _BLANKS.sub(" ", text)
        body = words.strip(" ")
        if not body:
            self.blank = self.blank or bool(words)
            return
        if words[0] == " ":
            self.blank = True
        self.word(body)
        self.blank = words[-1] == " "

    def lines(self, text: str) -> None:
        """Text whose line ends and blanks stay."""
        for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.line_end()
            if line:
                self.blank = False
                self.word(line)

    def text(self) -> str:
        return "".join(self.out).rstrip()


class Table:
    """Rows of cells; ``None`` marks a place that a cell above or to the left takes."""

    def __init__(self):
        self.rows: list[list[str | None]] = []
        self.below: dict[int, int] = {}

    def row(self) -> None:
        self.rows.append([])
        self._taken()

    def _taken(self) -> None:
        row = self.rows[-1]
        while self.below.get(len(row), 0) > 0:
            self.below[len(row)] -= 1
            row.append(None)

    def cell(self, text: str, across: int, down: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        for k in range(across):
            if down > 1:
                self.below[len(row)] = down - 1
            row.append(text if not k else None)
        self._taken()

    def text(self) -> str:
        split = [[(c or "").split("\n") for c in row] for row in self.rows]
        width: dict[int, int] = {}
        for row in split:
            for k, cell in enumerate(row):
                fits = [len(x) for x in cell if len(x) <= COLUMN_WIDTH]
                width[k] = max(width.get(k, 0), *fits, 0)
        lines = []
        for row in split:
            for k in range(max(map(len, row), default=0)):
                cells = [(cell[k] if k < len(cell) else "").ljust(width[j]) for j, cell in enumerate(row)]
                lines.append("  ".join(cells).rstrip())
        return "\n".join(x for x in lines if x)


class Element:
    __slots__ = ("name", "shown", "pre", "table", "across", "down", "count", "foreign", "drawn")

    def __init__(self, name: str, shown: bool, pre: bool):
        self.name, self.shown, self.pre = name, shown, pre
        self.table = None
        self.across = self.down = 1
        self.count = 0
        #: Inside svg or math; inside an svg image that is shown.
        self.foreign = self.drawn = False


class Builder:
    """The open elements and the formatting contexts they stand in."""

    def __init__(self):
        self.open = [Element("#page", True, False)]
        self.flows = [Flow()]
        self.names: dict[str, int] = {}

    # -- open elements
    def push(self, element: Element) -> None:
        self.open.append(element)
        self.names[element.name] = self.names.get(element.name, 0) + 1

    def close_upto(self, depth: int) -> None:
        while len(self.open) > depth:
            self.leave(self.open.pop())

    def find(self, wanted, within=()) -> int:
        """Depth of the innermost open element among ``wanted``, or -1."""
        if not any(self.names.get(w) for w in wanted):
            return -1
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name in wanted:
                return depth
            if self.open[depth].name in within:
                break
        return -1

    # -- tags
    def start(self, name: str, attributes: str) -> None:
        if self.open[-1].name == "head" and name not in HEAD_CONTENT:
            self.close_upto(len(self.open) - 1)
        while self.open[-1].foreign and name in BREAKOUT:
            self.close_upto(len(self.open) - 1)
        if name in IMPLIED_ENDS:
            wanted, within = IMPLIED_ENDS[name]
            while (depth := self.find(wanted, within)) > 0:
                self.close_upto(depth)
        if (name in SPACED or name in LINED) and name not in ("option", "optgroup", "tr", "caption") \
                and (depth := self.find(("p",), ("td", "th", "table", "button"))) > 0:
            self.close_upto(depth)
        if name in ("td", "th") and self.find(("tr",), ("table",)) < 0 and self.find(("table",)) > 0:
            self.start("tr", "")
        self.enter(name, attributes)

    def enter(self, name: str, attributes: str) -> None:
        above, flow = self.open[-1], self.flows[-1]
        found = {}
        for key, value in _ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
            found.setdefault(key.lower(), unescape(value.strip("\"'")) if value else "")
        shown = (above.shown or above.drawn) and name not in UNSEEN and "hidden" not in found \
            and not _HIDING.search(found.get("style", "")) \
            and not (name == "dialog" and "open" not in found) \
            and not (above.name == "details" and above.count < 0 and name != "summary")
        drawn = False
        if above.drawn:
            shown = shown and name not in SVG_UNSEEN and found.get("display", "").strip().lower() != "none" \
                and found.get("visibility", "").strip().lower() not in ("hidden", "collapse")
            drawn = shown and name != "foreignobject"
            shown = shown and (above.shown or name in ("text", "foreignobject"))
        if name == "svg":
            drawn, shown = drawn or shown, False
        element = Element(name, shown, above.pre or name in ("pre", "textarea", "xmp"))
        element.drawn = drawn
        element.foreign = name in ("svg", "math") or (above.foreign and name not in EMBEDDING)
        if name == "details" and "open" not in found:
            element.count = -1
        if shown:
            if name == "br":
                flow.line_end()
            elif name == "text" and drawn:
                flow.blank = True
            elif name == "foreignobject" and above.drawn:
                flow.block(1)
            elif name in SPACED:
                flow.block(2 if not (name in LISTS and self.find(LISTS) > 0) else 1)
            elif name in LINED:
                flow.block(1)
            if name == "hr":
                flow.word("---")
                flow.block(1)
            elif name == "input" and found.get("type", "text").lower() in ("submit", "button", "reset", "text", ""):
                flow.inline(found.get("value", ""))
            elif name in LISTS or name == "dd" or name == "blockquote":
                flow.indent += 1
                element.count = _number(found.get("start"), 1, -10**6) - 1 if name == "ol" else 0
            elif name == "li":
                depth = self.find(LISTS, ("td", "th"))
                flow.word(self.marker(depth))
                flow.blank = True
            elif name == "table":
                element.table = Table()
            elif name == "tr" and (table := self.table()):
                table.row()
            elif name in ("td", "th") and self.table():
                element.across, element.down = (_number(found.get(k), 1, 1, most) for k, most in
                                                (("colspan", 1000), ("rowspan", 65534)))
                self.flows.append(Flow())
                element.table = True
        if name not in VOID and not self.closed_itself(element, attributes):
            self.push(element)

    def closed_itself(self, element: Element, attributes: str) -> bool:
        """Whether a tag ends with a slash that closes its element, as in svg and math."""
        return attributes.rstrip().endswith("/") and (element.foreign or self.open[-1].foreign) \
            and not _UNQUOTED_END.search(attributes)

    def marker(self, depth: int) -> str:
        if depth > 0 and self.open[depth].name == "ol":
            self.open[depth].count += 1
            return f"{self.open[depth].count}."
        return "-"

    def table(self) -> Table | None:
        depth = self.find(("table",))
        return self.open[depth].table if depth > 0 else None

    def leave(self, element: Element) -> None:
        self.names[element.name] -= 1
        name = element.name
        if not element.shown:
            return
        if element.table is True:
            text = self.flows.pop().text()
            if table := self.table():
                table.cell(text, element.across, element.down)
            return
        flow = self.flows[-1]
        if name == "text" and element.drawn:
            flow.blank = True
        elif name == "foreignobject" and self.open[-1].drawn:
            flow.block(1)
        if name in LISTS or name == "dd" or name == "blockquote":
            flow.indent -= 1
        if name == "table" and (text := element.table.text()):
            flow.block(2)
            flow.lines(text)
        if name in SPACED:
            flow.block(2 if not (name in LISTS and self.find(LISTS) > 0) else 1)
        elif name in LINED:
            flow.block(1)

    def end(self, name: str) -> None:
        if name == "br":
            return self.start("br", "")
        if name == "p" and self.find(("p",), ("td", "th", "table")) < 0:
            self.start("p", "")
        within = () if name in ("table", "body", "html") else ("table",) if name in IMPLIED_ENDS else ("td", "th", "table")
        if (depth := self.find((name,), within)) > 0:
            self.close_upto(depth)

    def text(self, raw: str) -> None:
        if self.open[-1].name == "head" and raw.strip(" \t\n\r\f"):
            self.close_upto(len(self.open) - 1)
        top = self.open[-1]
        if not top.shown or (top.name == "details" and top.count < 0):
            return
        text = unescape(raw) if "&" in raw else raw
        if top.pre:
            self.flows[-1].lines(text)
        elif top.name not in ("table", "tr", "tbody", "thead", "tfoot") or text.strip():
            self.flows[-1].inline(text)


def _number(text: str | None, other: int, least: int, most: int = 10**6) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return min(max(int(found[1]), least), most) if found else other


def render(page: str) -> str:
    """The visible text of one page."""
    builder, at, size = Builder(), 0, len(page)
    while at < size:
        open_ = page.find("<", at)
        if open_ < 0:
            builder.text(page[at:])
            break
        if open_ > at:
            builder.text(page[at:open_])
        after = page[open_ + 1:open_ + 2]
        if found := _TAG.match(page, open_):
            at = found.end()
            name = found[2].lower()
            if found[1]:
                builder.end(name)
                continue
            builder.start(name, found[3])
            if name in RAW and builder.open[-1].name == name:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                builder.text(page[at:close.start() if close else size])
                at = close.start() if close else size
        elif page.startswith("<!--", open_):
            close = page.find("-->", open_ + 2)
            at = close + 3 if close >= 0 else size
        elif after in ("!", "?") or (after == "/" and not page[open_ + 2:open_ + 3].isalpha()):
            close = page.find(">", open_)
            at = close + 1 if close >= 0 else size
        elif after.isascii() and after.isalpha() or after == "/":
            break  # a tag without an end
        else:
            builder.text("&lt;")
            at = open_ + 1
    builder.close_upto(1)
    return builder.flows[0].text()


def extract(df: DataFrame, html_col: str = "html") -> DataFrame:
    """``df`` with ``text``, the visible text of each page."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([render(page) for page in batch.to_pylist()], pa.string())

    return df.withColumn("text", run(text_of(html_col)))
