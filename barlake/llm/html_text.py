"""Visible text of web pages by layout-aware rendering.

A tokenizer of one expression feeds a tree builder that supplies implied tags
(an open ``p`` ends before a block, ``li``, ``dd``, ``option``, rows and cells end
their kind, an end tag closes what was left open inside). The renderer walks the
tree once: hidden nodes and their children say nothing, blocks are parted by line
ends and paragraphs by an empty line, lists get their bullets or numbers and
indentation, the cells of a table are padded into columns, preformatted text
keeps its white space. Nothing visible is left out: navigation, advertisements
and footers are text as any other. Formulas say the text of their parts without
annotations, drawings that of their ``text`` and ``foreignObject`` elements (one
that is only drawn through ``use`` is left out), and a dialog shows when open.

Null html gives null text, empty html empty text. Markup that is broken is taken
as a browser would take it: stray end tags are dropped, unclosed elements end
with the page, a lone ``<`` is text. Both walks use explicit stacks, so depth is
bounded by memory only. Repeated rows get equal answers. All columns of the
pages are kept; one named as the result column is replaced.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the HTML standard: elements without content, raw text, blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
UNSEEN = frozenset(
    "head script style title noscript template iframe noembed noframes datalist object audio video canvas meta "
    "link base param source track area mphantom".split()
)
# Parts of a drawing that only describe it or are drawn where something refers to them.
UNDRAWN = UNSEEN | frozenset(
    "defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())
FOREIGN = frozenset("svg math".split())
BLOCK = frozenset(
    "html body address article aside blockquote center details dd dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre section summary table ul xmp caption mtr tr "
    "tbody thead tfoot".split()
)
PARTED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp ul ol dl table figure fieldset".split())
# An open element that a start tag ends, and the elements behind which it is not looked for.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
ENDS_P = (BLOCK - {"html", "body", "option", "optgroup", "mtr", "tr", "tbody", "thead", "tfoot", "caption", "legend"})
TABLE_PARTS = frozenset("table tr tbody thead tfoot".split())
SCOPE = frozenset("table td th caption button html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_BOX = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?[0-9]{1,9})(?![0-9])")
MOST_COLUMNS = 100  # that one cell spans
MOST_INDENT = 50  # levels of lists that are indented further
MOST_PAD = 200  # characters to which cells are padded; longer ones stand as they are
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_UNEVEN = re.compile(r"[\t\n\r\f]|  ")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None

    def unseen(self) -> bool:
        if self.tag in UNSEEN or (self.tag == "dialog" and self.attribute("open") is None):
            return True
        if not self.attributes:
            return False
        if "hidden" in self.attributes and (
                self.attribute("hidden") is not None or (self.tag == "input" and self.attribute("type") == "hidden")):
            return True
        return "style" in self.attributes and bool(_NO_BOX.search(self.attribute("style") or ""))

    def visible(self) -> bool | None:
        """What the element's own style says of visibility, if it does; elements inside may say otherwise."""
        if "style" not in self.attributes or not (said := _VISIBILITY.findall(self.attribute("style") or "")):
            return None
        return said[-1].lower() == "visible"

    def number(self, name: str, default: int) -> int:
        found = _NUMBER.match(self.attribute(name) or "")
        return int(found[1]) if found else default


def drawn_text(drawing: Node) -> list[Node]:
    """The elements of a drawing that say something, in their order, each as a block."""
    found: list[Node] = []
    work: list[tuple[Node, Node | None]] = [(c, None) for c in drawing.children[::-1] if isinstance(c, Node)]
    while work:
        node, inside = work.pop()
        if isinstance(node, str):
            inside.children.append(node)
            continue
        if node.tag in UNDRAWN or node.unseen() or node.visible() is False or node.attribute("display") == "none" or (
                node.attribute("visibility") in ("hidden", "collapse")):
            continue
        if node.tag == "foreignobject":
            shown = Node("div")
            shown.children = node.children
            found.append(shown)
            continue
        if node.tag == "text" and inside is None:
            inside = Node("div")
            found.append(inside)
        work += [(c, inside) for c in node.children[::-1] if inside is not None or isinstance(c, Node)]
    return found


def build_tree(page: str) -> Node:
    """The tree of a page; text children are strings."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # depths of the open elements of each name

    def innermost(names) -> int:
        """Depth of the innermost open element so named, or 0."""
        return max((places[n][-1] for n in names if places[n]), default=0)

    def cut(depth: int) -> None:
        for node in stack[depth:]:
            places[node.tag].pop()
        del stack[depth:]

    def close(names: set[str] | frozenset[str], barrier: set[str] | frozenset[str]) -> None:
        """Close the outermost open element so named that no barrier hides."""
        hidden = innermost(barrier)
        found = [at[k] for n in names if (k := bisect_right(at := places[n], hidden)) < len(at)]
        if found:
            cut(min(found))

    def foreign() -> bool:
        """Whether the innermost element is part of a drawing or a formula."""
        return innermost(FOREIGN) > innermost(("foreignobject", "annotation-xml"))

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        while mark >= 0 and not (m := _TOKEN.match(page, mark)):
            mark = page.find("<", mark + 1)
        if mark < 0:
            break
        if mark > at:
            stack[-1].children.append(html.unescape(page[at:mark]))
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "p" and not places["p"]:
                stack[-1].children.append(Node("p"))
            depth = innermost((tag,))
            if depth and (tag in TABLE_PARTS or depth >= innermost(("table", "td", "th"))):
                cut(depth)
            if tag == "br":
                stack[-1].children.append(Node("br"))
        elif m[2]:
            tag = m[2].lower()
            if tag in ENDS_P:
                close({"p"}, SCOPE)
            if tag in ENDS:
                close(*ENDS[tag])
            node = Node(tag, m[3])
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(page, at)
                inside = page[at : end.start() if end else size]
                if tag in ("textarea", "title"):
                    node.children.append(html.unescape(inside))
                elif tag == "xmp":
                    node.children.append(inside)
                at = end.end() if end else size
            elif tag not in VOID and not (m[3].endswith("/") and (tag in ("svg", "path", "math") or foreign())):
                places[tag].append(len(stack))
                stack.append(node)
    if at < size:
        stack[-1].children.append(html.unescape(page[at:]))
    return root


class Page:
    """Text in the making: lines, with the blank and empty-line rules applied as it grows."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap = 0  # line ends owed before the next text
        self.blank = False
        self.prefix = ""
        self.empty = True  # nothing on the present line yet

    def part(self, lines: int) -> None:
        self.gap = max(self.gap, lines)
        self.blank = False

    def write(self, text: str, kept: bool = False) -> None:
        if not kept:
            collapsed = _BLANKS.sub(" ", text) if _UNEVEN.search(text) else text
            if not collapsed:
                return
            lead, tail, text = collapsed[0] == " ", collapsed[-1] == " ", collapsed.strip(" ")
            self.blank = self.blank or lead
            if not text:
                return
        elif not text:
            return
        if self.gap and self.parts:
            self.parts.append("\n" * self.gap)
            self.empty = True
        self.gap = 0
        if self.empty:
            self.parts.append(self.prefix)
            self.prefix = " " * len(self.prefix)
        elif self.blank:
            self.parts.append(" ")
        self.parts.append(text if not kept else text.replace("\n", "\n" + self.prefix))
        self.empty, self.blank = False, (not kept and tail)

    def text(self) -> str:
        return "".join(self.parts)


def aligned(rows: list[list[str]]) -> str:
    """Cells padded into columns; the lines of a cell stay inside its column."""
    split = [[cell.split("\n") for cell in row] for row in rows]
    widths: list[int] = []
    for row in split:
        for k, cell in enumerate(row):
            width = min(max(map(len, cell)), MOST_PAD)
            if k < len(widths):
                widths[k] = max(widths[k], width)
            else:
                widths.append(width)
    lines = []
    for row in split:
        for n in range(max(map(len, row), default=0)):
            cells = [(cell[n] if n < len(cell) else "").ljust(widths[k]) for k, cell in enumerate(row)]
            lines.append(" | ".join(cells).rstrip())
    return "\n".join(lines)


class Table:
    """Rows of cells; a cell keeps its place free in the rows that it reaches down to."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.taken: dict[int, int] = {}  # column: the last row that a cell from above reaches

    def add(self, text: str, columns: int, rows: int) -> None:
        row, at = self.rows[-1], len(self.rows) - 1
        while self.taken.get(len(row), -1) >= at:
            row.append("")
        for k in range(columns if rows != 1 else 0):
            self.taken[len(row) + k] = at + rows - 1 if rows else 1 << 30
        row += [text, *[""] * (columns - 1)]


def render(root: Node) -> str:
    """The visible text of a tree.

    ``work`` holds what is still to be done: a node to open, or a step to take
    when all inside a node is done. Tables render their cells on pages of their own.
    """
    pages = [Page()]
    lists: list[list] = []  # [kind, next number]
    tables: list[Table] = []
    shown = True
    work: list = [root]
    kept = 0
    while work:
        step = work.pop()
        if callable(step):
            step()
            continue
        page = pages[-1]
        if isinstance(step, str):
            if shown:
                page.write(step, kept > 0)
            continue
        tag = step.tag
        if step.unseen():
            continue
        said = step.visible()
        if said is not None and said != shown:
            def restored(old=shown):
                nonlocal shown
                shown = old
            work.append(restored)
            shown = said
        if tag == "br":
            page.gap, page.blank = page.gap + 1, False
            continue
        if tag == "hr":
            page.part(2)
            if shown:
                page.write("---")
                page.part(2)
            continue
        if tag in ("img", "input"):
            said = step.attribute("alt" if tag == "img" else "value")
            if said and shown and not (tag == "input" and step.attribute("type") in ("checkbox", "radio", "password", "file")):
                page.write(said)
            continue
        gap = (2 if tag in PARTED and not (lists and tag in ("ul", "ol")) else 1) if tag in BLOCK else 0
        done = []
        if gap:
            page.part(gap)
            done.append(lambda page=page, gap=gap: page.part(gap))
        if tag in ("ul", "ol", "menu"):
            lists.append([tag, step.number("start", 1) if tag == "ol" else 1])
            done.append(lists.pop)
        elif tag == "li":
            kind, number = lists[-1] if lists else ("ul", 1)
            old = page.prefix
            page.prefix = "  " * min(max(len(lists) - 1, 0), MOST_INDENT) + (f"{number}. " if kind == "ol" else "- ")
            if lists:
                lists[-1][1] += 1
            done.append(lambda page=page, old=old: setattr(page, "prefix", old))
        elif tag == "mtd":
            page.blank = True
        elif tag in ("pre", "xmp"):
            kept += 1

            def shut():
                nonlocal kept
                kept -= 1
            done.append(shut)
        elif tag == "q":
            if shown:
                page.write('"', True)
                done.append(lambda page=page: page.write('"', True))
        elif tag == "table":
            tables.append(Table())

            def laid(page=page):
                rows = [r for r in tables.pop().rows if r]
                if rows:
                    page.write(aligned(rows), True)
            done.insert(0, laid)
        elif tag in ("tbody", "thead", "tfoot") and tables:
            tables[-1].taken.clear()
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag in ("td", "th") and tables:
            if not tables[-1].rows:
                tables[-1].rows.append([])
            pages.append(Page())
            outer_lists, lists = lists, []

            def cell(step=step, outer=outer_lists, depth=len(tables) - 1):
                nonlocal lists
                lists = outer
                columns = min(max(step.number("colspan", 1), 1), MOST_COLUMNS)
                tables[depth].add(pages.pop().text(), columns, max(step.number("rowspan", 1), 0))
            done.append(cell)
        work += done[::-1]
        children = step.children
        if tag == "svg":
            children = drawn_text(step)
        elif tag == "details" and step.attribute("open") is None:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        elif tag == "semantics":
            children = [c for c in children if isinstance(c, str) or c.tag not in ("annotation", "annotation-xml")]
        work += children[::-1]
    return pages[0].text().rstrip()


def page_text(page: str | None) -> str | None:
    return None if page is None else render(build_tree(page))


def _extract(column: str, result: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(x.as_py()) for x in batch.column(column)]
            kept = [c for c in batch.schema.names if c != result]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())],
                                             names=[*kept, result])

    return run


def extract_text(pages: DataFrame, column: str = "html", result: str = "text") -> DataFrame:
    """``pages`` with the visible text of each page."""
    kept = [f for f in pages.schema.fields if f.name != result]
    schema = T.StructType([*kept, T.StructField(result, T.StringType())])
    return pages.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(_extract(column, result), schema)
