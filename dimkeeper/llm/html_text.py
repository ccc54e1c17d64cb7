"""HTML extraction by layout-aware rendering: a tree with implied tags, then its visible text."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import shuffle as sh
from dimkeeper.llm.ship import ship

RESULT = "page_id long, url string, title string, text string"

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes audio video canvas datalist area param rp meter progress annotation annotation-xml".split()
)
#: Within a drawing only these show text, and these do not even there.
DRAWN = frozenset("text foreignobject".split())
UNDRAWN = frozenset("title desc metadata defs style script symbol clippath mask pattern marker lineargradient radialgradient filter".split())
#: Kinds of input whose value is not shown as text.
MUTE = frozenset("hidden checkbox radio file color range password".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul tr thead tbody tfoot".split()
)
SPACED = frozenset("article blockquote dl fieldset figure form h1 h2 h3 h4 h5 h6 main ol p pre section table ul".split())
#: Elements that a start tag ends, and the elements beyond which it does not reach.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "caption", "colgroup", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_SCOPE = {"td", "th", "table", "caption", "button", "object", "html"}
HEAD_ONLY = frozenset("base link meta noscript script style template title head html".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"[ \t\n\f\r]+")
GONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.I)

#: A table with a longer line in a cell, or with blocks side by side of which one is longer, lays out a page:
#: its cells follow one another. In other tables cells are aligned.
WIDEST = 120

# The most columns and rows that a cell may span.
COLUMNS, ROWS = 1000, 65_534


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        """The value of an attribute, '' for one without a value."""
        if name not in self.attributes.lower():
            return None
        for key, value in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value[1:-1] if value[:1] in "\"'" else value)
        return None


class Open(list):
    """The open elements, outermost first, and how many there are of each tag."""

    def __init__(self, root: Node) -> None:
        super().__init__([root])
        self.count = Counter([root.tag])

    def push(self, node: Node) -> None:
        self[-1].children.append(node)
        self.append(node)
        self.count[node.tag] += 1

    def cut(self, at: int) -> None:
        self.count.subtract(x.tag for x in self[at:])
        del self[at:]


def parse(source: str) -> Node:
    """The tree of a page: start tags end what cannot hold them, end tags end what they name."""
    root = Node("html")
    stack, at = Open(root), 0
    n, last = len(source), source.rfind(">") + 1
    while at < n:
        token = TOKEN.search(source, at, last) or LOOSE.search(source, at, last)
        before = source[at : token.start()] if token else source[at:]
        if before:
            if stack[-1].tag == "head" and before.strip():
                stack.cut(len(stack) - 1)
            stack[-1].children.append(html.unescape(before))
        if token is None:
            break
        at = token.end()
        if token[2] is None:
            continue
        tag = token[2].lower()
        if token[1]:
            _end(stack, tag)
        else:
            at = _start(stack, tag, token[3], source, at)
    return root


def _start(stack: Open, tag: str, attributes: str, source: str, at: int) -> int:
    if tag == "html" or (tag == "body" and stack.count["body"]):
        return at
    if tag not in HEAD_ONLY and stack[-1].tag == "head":
        stack.cut(len(stack) - 1)
    if tag in ENDS:
        _close(stack, *ENDS[tag])
    if tag in BLOCK and tag not in ("body", "html"):
        _close(stack, {"p"}, P_SCOPE)
    if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
        stack.push(Node("tr"))
    node = Node(tag, attributes)
    if tag in RAW:
        stack[-1].children.append(node)
        end = re.compile(f"</{tag}\\s*>?", re.I).search(source, at)
        body = source[at : end.start()] if end else source[at:]
        node.children.append(html.unescape(body) if tag in ("title", "textarea") else body)
        return end.end() if end else len(source)
    if tag not in VOID and not (attributes.endswith("/") and tag in ("path", "circle", "rect", "g", "use")):
        stack.push(node)
    else:
        stack[-1].children.append(node)
    return at


def _close(stack: Open, tags: set[str], scope: set[str]) -> None:
    """Ends the outermost of the open ``tags`` within the scope."""
    if not any(stack.count[t] for t in tags):
        return
    found = 0
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in scope:
            break
        if stack[k].tag in tags:
            found = k
    if found:
        stack.cut(found)


def _end(stack: Open, tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br"))
        return
    table_part = tag in ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "body", "html")
    for k in range(len(stack) - 1, 0, -1) if stack.count[tag] else ():
        if stack[k].tag == tag:
            stack.cut(k)
            return
        if stack[k].tag in ("td", "th", "table") and not table_part and tag not in ("article", "main", "section", "div", "form"):
            break
    if tag == "p":
        stack[-1].children.append(Node("p"))


class Out:
    """Lines with collapsed white space; breaks and spaces wait until text follows."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.space = 0, False
        self.indents: list[str] = []
        self.marker = ""

    def line(self, breaks: int) -> None:
        if self.parts:
            self.breaks = max(self.breaks, breaks)
        self.space = False

    def _lead(self) -> None:
        if self.breaks or not self.parts:
            self.parts.append("\n" * self.breaks)
            indent = "".join(self.indents)
            self.parts.append(indent[: len(indent) - len(self.marker)] + self.marker if self.marker else indent)
            self.marker, self.breaks, self.space = "", 0, False
        elif self.space:
            self.parts.append(" ")
            self.space = False

    def text(self, value: str) -> None:
        words = SPACE.split(value)
        if words[0] == "":
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self._lead()
            self.parts.append(body)
            self.space = words[-1] == ""

    def keep(self, value: str) -> None:
        """Text with its own line breaks and spaces."""
        for k, row in enumerate(value.split("\n")):
            if k:
                self.breaks = max(self.breaks, 0) + 1 if self.parts else 0
            if row:
                self._lead()
                self.parts.append(row)

    def value(self) -> str:
        return "".join(self.parts)


def _span(value: str | None, most: int) -> int:
    """A colspan or rowspan; 0 stands for all that follows."""
    number = int(value) if value and value.isdecimal() and len(value) < 9 else 1
    return most if not number and most == ROWS else min(max(number, 1), most)


class Table:
    """Cells by row and column, each a list of lines."""

    def __init__(self) -> None:
        self.rows: list[dict[int, tuple[list[str], int]]] = []  # by first column: lines, columns
        self.taken: dict[int, tuple[int, int]] = {}  # of cells that reach into this row: rows left, columns
        self.below: dict[int, tuple[int, int]] = {}  # and into the next one
        self.at = 0

    def row(self) -> None:
        self.rows.append({})
        self.at = 0
        self.taken, self.below = self.below, {}
        for column, (left, wide) in self.taken.items():
            self.rows[-1][column] = ([], wide)
            if left > 1:
                self.below[column] = (left - 1, wide)

    def cell(self, value: str, colspan: str | None, rowspan: str | None) -> None:
        if not self.rows:
            self.row()
        while self.at in self.taken:
            self.at += self.taken[self.at][1]
        wide, high = _span(colspan, COLUMNS), _span(rowspan, ROWS)
        self.rows[-1][self.at] = ([x.rstrip() for x in value.split("\n") if x.strip()], wide)
        if high > 1:
            self.below[self.at] = (high - 1, wide)
        self.at += wide

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if any(lines for lines, _ in r.values())]
        cells = [cell for row in rows for cell in row.values()]
        if any(len(x) > WIDEST for lines, _ in cells for x in lines) and any(len([c for c in row.values() if c[0]]) > 1 for row in rows):
            return [x for row in rows for k in sorted(row) for x in row[k][0]]
        columns = sorted({k for row in rows for k in row})
        place = {column: k for k, column in enumerate(columns)}
        widths = [0] * len(columns)
        several = []
        for row in rows:
            for column, (lines, wide) in row.items():
                if wide > 1:
                    several.append((column, max(map(len, lines), default=0), wide))
                else:
                    widths[place[column]] = max(widths[place[column]], *map(len, lines), 0)
        for column, length, wide in several:  # a cell over several columns widens the last of them
            over = [k for k in range(place[column], len(columns)) if columns[k] < column + wide]
            widths[over[-1]] += max(0, length - sum(widths[k] for k in over) - 3 * (len(over) - 1))
        starts = [0]
        for width in widths:
            starts.append(starts[-1] + width + 3)
        out = []
        for row in rows:
            cells_of = sorted(row.items())
            for k in range(max(len(lines) for lines, _ in row.values())):
                last = max(n for n, (_, (lines, _)) in enumerate(cells_of) if len(lines) > k)
                line = ""
                for n, (column, (lines, _)) in enumerate(cells_of[: last + 1]):
                    line = line.ljust(starts[place[column]] - 3) + " | " if n else line
                    line += lines[k] if k < len(lines) else ""
                out.append(line)
        return out


def shown(node: Node) -> bool:
    """Whether an element has a box at all."""
    if node.tag in UNSEEN:
        return False
    if node.tag == "dialog":
        return node.get("open") is not None
    if node.tag == "object":
        return node.get("data") is None  # else its resource is shown, not its content
    low = node.attributes.lower()
    if "hidden" in low or "none" in low:
        return node.get("hidden") is None and not GONE.search(node.get("style") or "")
    return True


def inked(node: Node, before: bool) -> bool:
    """Whether its text is painted: visibility is inherited, and may be set anew within."""
    if "visibility" not in node.attributes.lower():
        return before
    found = VISIBILITY.findall(node.get("style") or "")
    return found[-1].lower() == "visible" if found else before


def _plain(node: Node) -> str:
    parts, todo = [], list(reversed(node.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            todo += reversed(x.children)
    return SPACE.sub(" ", "".join(parts)).strip()


def choices(select: Node) -> list[str]:
    """What a select shows: the chosen option, by default the first; all of them in a list box."""
    options, todo = [], list(reversed(select.children))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            continue
        if x.tag == "option":
            options.append(x)
        else:
            todo += reversed(x.children)
    size = select.get("size") or ""
    if select.get("multiple") is None and not (size.isdecimal() and size.strip("0") not in ("", "1")):
        chosen = [x for x in options if x.get("selected") is not None]
        options = chosen[-1:] or options[:1]
    return [x.get("label") or _plain(x) for x in options]


def render(root: Node) -> tuple[str, str]:
    """Title and visible text."""
    title = ""
    outs, tables, lists, pre = [Out()], [], [], 0
    todo: list[tuple[Node | str, bool, bool, bool]] = [(root, True, True, False)]  # node, opening, painted, only drawn text counts
    while todo:
        node, opening, ink, drawing = todo.pop()
        out = outs[-1]
        if isinstance(node, str):
            if ink and not drawing:
                out.keep(node) if pre else out.text(node)
            continue
        tag = node.tag
        if opening:
            if tag in ("head", "title") and not drawing:
                for child in [node] if tag == "title" else node.children:
                    if not isinstance(child, str) and child.tag == "title" and not title:
                        title = SPACE.sub(" ", "".join(c for c in child.children if isinstance(c, str))).strip()
                continue
            if not shown(node) or (drawing and tag in UNDRAWN):
                continue
            ink = inked(node, ink)
            if tag == "br":
                out.breaks = out.breaks + 1 if out.parts else 0
                out.space = False
                continue
            if tag == "hr":
                out.line(1)
                out.text("---" if ink else "")
                out.line(1)
                continue
            if tag in ("img", "input"):
                kind = (node.get("type") or "").lower() if tag == "input" else "image"
                label = node.get("alt") if kind == "image" else None if kind in MUTE else node.get("value")
                if label and ink:
                    out.text(f" {label} " if tag == "input" else label)
                continue
            if tag == "select":
                options = choices(node) if ink else []
                for k, option in enumerate(options):
                    out.line(1) if k else None
                    out.text(f" {option} ")
                continue
            if tag in BLOCK or (drawing and tag in DRAWN):
                out.line(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.get("start") if tag == "ol" else None
                lists.append(int(start) if start and start.isdigit() and len(start) < 9 else 1 if tag == "ol" else 0)
            elif tag == "li":
                number = lists[-1] if lists else 0
                marker = f"{number}. " if number else "- "
                if number:
                    lists[-1] += 1
                out.indents.append(" " * len(marker))
                out.marker = marker
            elif tag in ("blockquote", "dd"):
                out.indents.append("  ")
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("td", "th") and tables:
                outs.append(Out())
            elif tag == "q" and ink:
                out.text('"')
            inside = tag == "svg" or (drawing and tag not in DRAWN)
            children = node.children
            if tag == "details" and node.get("open") is None:
                children = [x for x in children if not isinstance(x, str) and x.tag == "summary"][:1]
            todo.append((node, False, ink, drawing))
            todo += [(child, True, ink, inside) for child in reversed(children)]
            continue
        if tag in ("td", "th") and tables:
            tables[-1].cell(outs.pop().value(), node.get("colspan"), node.get("rowspan"))
            continue
        if tag == "table" and tables:
            for row in tables.pop().lines():
                out.line(1)
                out._lead()
                out.parts.append(row)
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag in ("li", "blockquote", "dd") and out.indents:
            out.indents.pop()
            out.marker = ""
        elif tag == "pre":
            pre -= 1
        elif tag == "q" and ink:
            out.text('"')
        if tag in BLOCK or (drawing and tag in DRAWN):
            out.line(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
    return title, outs[0].value().strip("\n")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, sources = sh.columns_of(batch, "page_id", "url", "html")
        found = [render(parse(s)) if s else ("", "") for s in sources.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [ids, urls, pa.array([t for t, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())], names=["page_id", "url", "title", "text"]
        )


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """The title and all visible text of each page: (page_id, url, title, text), one row for each row.

    Blocks are on lines of their own, paragraphs, headings, lists and tables after an empty line. List
    items have their mark or number, preformatted text keeps its lines. Table cells are aligned by column,
    with their blocks as lines side by side, over several columns or rows where they span them; a table with
    lines of more than ``WIDEST`` characters beside other cells lays out a page, and its cells follow one another.

    Text counts as visible as in a browser without scripts and style sheets: ``hidden``, ``display: none`` and
    ``visibility`` of style attributes (inherited, and set anew within), closed details and dialogs, the shown option
    of a select, the text of drawings and formulas, the content of an object without a resource. No text is taken
    from noscript, from fallback content of audio, video, canvas, iframe, meter and progress, nor from style sheets.

    * null or empty page: empty title and text; null id or url stay null
    * unclosed, stray or wrongly nested tags: as far as a browser's rules are followed, else ignored
    * repeated rows: each has its result; other columns are ignored, whatever their names
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html"))
    return rows.mapInArrow(_pages, RESULT)
