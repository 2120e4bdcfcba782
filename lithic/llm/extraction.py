"""HTML extraction that renders a page: a tree with implied tags, visibility rules, and a layout of all visible text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: kinds of elements by their names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title plaintext".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes object embed audio video canvas datalist area map "
    "param source track base link meta title select".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p pre search section "
    "summary table caption ul xmp plaintext".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure menu dir listing xmp hr".split())
PRE = frozenset("pre textarea listing xmp plaintext".split())
# A start tag of the key closes the open elements of the first set, up to one of the second.
_SCOPE = frozenset("html body table td th caption template object button".split())
_ENDS_P = BLOCK - frozenset("html body caption option optgroup legend".split())
IMPLIED = {
    "li": (frozenset(["li"]), _SCOPE | {"ul", "ol", "menu", "dir"}),
    "dt": (frozenset(["dt", "dd"]), _SCOPE | {"dl"}),
    "dd": (frozenset(["dt", "dd"]), _SCOPE | {"dl"}),
    "option": (frozenset(["option"]), _SCOPE | {"select", "datalist"}),
    "optgroup": (frozenset(["option", "optgroup"]), _SCOPE | {"select", "datalist"}),
    "rt": (frozenset(["rt", "rp"]), _SCOPE | {"ruby"}),
    "rp": (frozenset(["rt", "rp"]), _SCOPE | {"ruby"}),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table", "template", "html"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table", "template", "html"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table", "template", "html"])),
}
_SECTION = (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table", "html"]))
IMPLIED |= dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup"), _SECTION)
#: Spans beyond these are read as these.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: Cells are aligned up to this column; beyond it they follow two spaces after the text before, so that a long cell
#: doesn't widen every line of its table.
MOST_ALIGNED = 1000
#: Elements nested deeper are placed in the last one that isn't.
DEPTH = 512

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|(?<==)\s*\"[^\"]*\"|(?<==)\s*'[^']*'|[\"'])*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
#: Elements that visibility "collapse" takes out of their table; others are hidden by it.
COLLAPSING = frozenset("tr tbody thead tfoot col colgroup".split())
SPACES = re.compile(r"[ \t\n\r\f]+")


@dataclass(slots=True)
class Node:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(next(filter(None, values), "")))
    return found


class TreeBuilder:
    """Builds the tree of a page as browsers read it in what matters for text: implied ends, stray and missing tags."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]

    def text(self, text: str) -> None:
        if text:
            # The head ends where text begins, as its end tag may be left out.
            if len(self.open) > 1 and self.open[-1].name == "head" and text.strip(" \t\n\r\f"):
                self.open.pop()
            self.open[-1].children.append(text)

    def close_to(self, names: frozenset[str], stop: frozenset[str]) -> None:
        """Close the outermost open element of ``names`` above the nearest of ``stop``."""
        cut = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name in names:
                cut = k
            if self.open[k].name in stop:
                break
        if cut is not None:
            del self.open[cut:]

    def start(self, name: str, attributes: str) -> None:
        if name in ("html", "body"):  # the tree has one of each, implied
            if name == "body":  # ends an open head
                self.close_to(frozenset(["head"]), frozenset(["template"]))
            return
        if name in IMPLIED:
            self.close_to(*IMPLIED[name])
        elif name in _ENDS_P:
            self.close_to(frozenset(["p"]), _SCOPE)
        if len(self.open) > 1 and self.open[-1].name == "head" and name not in HIDDEN:
            self.open.pop()
        node = Node(name, attributes_of(attributes) if attributes else {})
        self.open[-1].children.append(node)
        if name not in VOID and len(self.open) < DEPTH:
            self.open.append(node)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
        stop = frozenset(["table"]) if name not in ("table", "template") and name not in _SECTION[0] else frozenset()
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name == name:
                del self.open[k:]
                return
            if self.open[k].name in stop or (name not in BLOCK and self.open[k].name in ("td", "th", "caption")):
                return  # an end tag doesn't reach out of a cell

    def build(self, page: str) -> Node:
        at, size = 0, len(page)
        while at < size:
            match = TOKEN.search(page, at)
            if not match:
                self.text(unescape(page[at:]))
                break
            self.text(unescape(page[at : match.start()]) if match.start() > at else "")
            at = match.end()
            name = (match["name"] or "").lower()
            if name and match["end"]:
                self.end(name)
            elif name:
                self.start(name, match["attributes"])
                if name in RAW:
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                    until = close.start() if close and name != "plaintext" else size
                    raw = page[at:until]
                    self.text(unescape(raw) if name in ("textarea", "title") else raw)
                    at = until
        return self.root


def declared(node: Node) -> dict[str, str]:
    """What an element's style says of display and visibility; the last word counts."""
    style = node.attributes.get("style")
    return {name.lower(): value.lower() for name, value in DECLARED.findall(style)} if style else {}


def is_laid_out(node: Node) -> bool:
    """Whether an element, with all inside it, has a place on the page."""
    given = node.attributes
    if node.name in HIDDEN and not (node.name == "object" and not given.keys() & {"data", "type"}):
        return False  # an object that shows nothing of its own has its content shown
    if "hidden" in given and given["hidden"].lower() != "until-found":
        return False
    style = declared(node)
    if style.get("display") == "none" or (style.get("visibility") == "collapse" and node.name in COLLAPSING):
        return False
    return not (node.name == "dialog" and "open" not in given)


def is_shown(node: Node, around: bool) -> bool:
    """Whether the text of an element is to be seen, given whether that around it is. It keeps its place if not."""
    said = declared(node).get("visibility")
    if said in ("hidden", "collapse"):
        return False
    return True if said in ("visible", "initial") else around


class Layout:
    """Lines of text that grow as a page is walked through."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.space = False
        self.gap = 0  # empty lines owed before the next text
        self.prefix: list[str] = []  # indents of lists and quotes around
        self.marker = ""  # of a list item, for its first line

    def inline(self, text: str) -> None:
        """Text whose runs of space are one space, none at the ends of a line."""
        if not text:
            return
        body = SPACES.sub(" ", text)
        if body[0] == " ":
            self.space, body = True, body[1:]
        if body:
            if self.line and self.space:
                self.line += " "
            self.space = body.endswith(" ")
            self.line += body.rstrip(" ")

    def kept(self, text: str) -> None:
        """Text with its spaces and line ends."""
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line += (" " if self.space and self.line else "") + first
        self.space = False
        for more in rest:
            self.break_line(always=True)
            self.line = more

    def break_line(self, always: bool = False) -> None:
        if self.line.strip() or always:
            indent = "".join(self.prefix)
            if self.marker:
                indent, self.marker = indent[: len(indent) - len(self.marker)] + self.marker, ""
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines.append((indent + self.line).rstrip())
        self.line, self.space = "", False

    def block(self, empty: int = 0) -> None:
        """End the line; ``empty`` lines come before what follows, unless more are owed."""
        self.break_line()
        self.gap = max(self.gap, empty)

    def result(self) -> list[str]:
        self.break_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def number(text: str | None, least: int, most: int, otherwise: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return min(most, max(least, int(found[1]))) if found else otherwise


def render(root: Node) -> list[str]:
    """Lines of all visible text. Works with a stack, so deep nesting can't exhaust it.

    What is hidden by its visibility keeps its place, and elements inside it may turn it on again.
    """
    out = Layout()
    # What is to be done, last first: a node or a text, with whether spaces are kept and whether text is shown, or a call
    # that ends an element.
    stack: list = [(root, (False, True))]
    outer: list[Layout] = []
    counters: list[list[int] | None] = []

    def ends(call) -> None:
        stack.append((call, None))

    while stack:
        item, state = stack.pop()
        if state is None:
            item()
            continue
        pre, shown = state
        if isinstance(item, str):
            if shown:
                out.kept(item) if pre else out.inline(item)
            continue
        name = item.name
        if not is_laid_out(item):
            continue
        shown = is_shown(item, shown)
        if name == "br":
            out.break_line(always=True)
            continue
        if name == "hr":
            out.block(1)
            out.line = "----" if shown else ""
            out.block(1)
            continue
        if name == "input":
            if shown and item.attributes.get("type", "text").lower() in ("submit", "button", "reset"):
                out.inline(item.attributes.get("value", ""))
            continue
        if name == "img":
            out.inline(item.attributes.get("alt", "") if shown else "")
            continue
        if name == "table":
            out.block(1)
            cells, grid, caption = table_cells(item, shown)
            texts: dict[int, list[str]] = {}
            target = out

            def finish(target=target, grid=grid, texts=texts, caption=caption) -> None:
                nonlocal out
                out = target
                for line in texts.get(-1, []):
                    out.line = line
                    out.break_line()
                for line in aligned(grid, texts):
                    out.line = line
                    out.break_line(always=True)
                out.block(1)

            ends(finish)
            parts = ([(-1, caption, is_shown(caption, shown))] if caption else []) + [
                (k, cell, seen) for k, (cell, seen) in enumerate(cells)
            ]
            for k, cell, seen in reversed(parts):
                inner = Layout()

                def leave(k=k, inner=inner, texts=texts) -> None:
                    texts[k] = inner.result()

                def enter(inner=inner) -> None:
                    nonlocal out
                    out = inner

                ends(leave)
                stack.extend((child, (pre, seen)) for child in reversed(cell.children))
                ends(enter)
            continue
        children = item.children
        if name == "details" and "open" not in item.attributes:  # closed: its summary alone is shown
            children = [x for x in children if isinstance(x, Node) and x.name == "summary"][:1]
        keeps = pre or name in PRE
        if name in BLOCK:
            nested = name in ("ul", "ol", "menu", "dir", "dl") and bool(out.prefix)
            empty = 0 if nested or name not in SPACED else 1
            out.block(empty)
            target, size = out, len(out.prefix)
            if name in ("ol", "ul", "menu", "dir"):
                step = -1 if "reversed" in item.attributes else 1
                items = sum(isinstance(x, Node) and x.name == "li" for x in children) if step < 0 else 1
                first = number(item.attributes.get("start"), -(10**8), 10**8, items)
                counters.append([first, step] if name == "ol" else None)
            elif name == "li":
                counter = counters[-1] if counters else None
                if counter:
                    counter[0] = number(item.attributes.get("value"), -(10**8), 10**8, counter[0])
                    marker = f"{counter[0]}. "
                    counter[0] += counter[1]
                else:
                    marker = "- "
                out.prefix.append(" " * len(marker))
                out.marker = marker if shown else ""
            elif name in ("blockquote", "dd"):
                out.prefix.append("  ")

            def close(target=target, size=size, empty=empty, name=name) -> None:
                target.block(empty)
                del target.prefix[size:]
                if name == "li":
                    target.marker = ""
                elif name in ("ol", "ul", "menu", "dir"):
                    counters.pop()

            ends(close)
        if name == "pre" and children and isinstance(children[0], str) and children[0].startswith("\n"):
            children = [children[0][1:], *children[1:]]
        elif name == "q":
            children = ["“", *children, "”"]
        stack.extend((child, (keeps, shown)) for child in reversed(children))
    return out.result()


def table_cells(
    table: Node, shown: bool = True
) -> tuple[list[tuple[Node, bool]], list[list[tuple[int, int, int, int]]], Node | None]:
    """Cells of a table with whether they are shown, their places (row, column, columns, cell number) by row, its caption.

    Whatever stands in a table outside a cell forms a cell of its own row.
    """
    cells: list[tuple[Node, bool]] = []
    grid: list[list[tuple[int, int, int, int]]] = []
    caption, taken = None, {}

    def row(children: list[Node | str], shown: bool) -> None:
        here, column = len(grid), 0
        grid.append([])
        for child in children:
            if isinstance(child, str) and not child.strip():
                continue
            cell = child if isinstance(child, Node) else Node("td", {}, [child])
            if not is_laid_out(cell):
                continue
            seen = is_shown(cell, shown)
            if cell.name not in ("td", "th"):
                cell = Node("td", {}, [cell])
            while taken.get(column, 0) > here:
                column += 1
            across = number(cell.attributes.get("colspan"), 1, MOST_COLUMNS, 1)
            down = number(cell.attributes.get("rowspan"), 0, MOST_ROWS, 1) or MOST_ROWS
            for k in range(column, column + across):
                taken[k] = here + down
            grid[-1].append((here, column, across, len(cells)))
            cells.append((cell, seen))
            column += across

    pending = [(child, shown) for child in reversed(table.children)]
    while pending:
        child, around = pending.pop()
        if isinstance(child, str):
            if child.strip():
                row([child], around)
        elif child.name == "caption":
            caption = caption or (child if is_laid_out(child) else None)
        elif child.name in ("thead", "tbody", "tfoot"):
            if is_laid_out(child):
                inside = is_shown(child, around)
                pending.extend((x, inside) for x in reversed(child.children))
        elif child.name == "tr":
            if is_laid_out(child):
                row(child.children, is_shown(child, around))
        elif child.name not in ("colgroup", "col") and is_laid_out(child):
            row([child], around)
    return cells, grid, caption


def aligned(grid: list[list[tuple[int, int, int, int]]], texts: dict[int, list[str]]) -> Iterator[str]:
    """Lines of a table whose cells start at the same place in every row."""
    widths: dict[int, int] = {}
    last = max((column + across for cells in grid for _, column, across, _ in cells), default=0)
    placed = sorted((across, column, cell) for cells in grid for _, column, across, cell in cells)
    for across, column, cell in placed:
        need = max(map(len, texts.get(cell, [])), default=0)
        # Columns without text take no room, the others two spaces more than their text.
        have = max(0, sum(widths[k] + 2 for k in range(column, column + across) if widths.get(k)) - 2)
        if need > have:  # the last of the columns it spans grows
            end = column + across - 1
            new = 2 if have and not widths.get(end) else 0
            widths[end] = widths.get(end, 0) + max(1, need - have - new)
    starts = [0]
    for k in range(last):
        starts.append(starts[-1] + (widths[k] + 2 if widths.get(k) else 0))
    for cells in grid:
        height = max((len(texts.get(cell, [])) for *_, cell in cells), default=0)
        for at in range(height):
            line = ""
            for _, column, _, cell in cells:
                lines = texts.get(cell, [])
                if at < len(lines) and lines[at]:
                    apart = line + "  " if line and starts[column] > MOST_ALIGNED else line
                    line = apart.ljust(min(starts[column], MOST_ALIGNED)) + lines[at]
            yield line


def extract(page: str | None) -> str:
    """The visible text of a page; none for a null or empty one."""
    return "\n".join(render(TreeBuilder().build(page.replace("\0", "�")))) if page else ""


def extracted(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """Add the visible text ``into`` of each whole page.

    A null or empty page has an empty text; any other input is read as far as it makes sense, as browsers do. Equal pages
    get equal texts. Texts of any length are read whole, in one task each. A drop-down list and what only browsers without
    scripts show are left out. A column of the name ``into`` is replaced, all others stay.
    """

    @F.pandas_udf("string")
    def rendered(values: pd.Series) -> pd.Series:
        return pd.Series([extract(x) for x in values], dtype=object)

    return pages.withColumn(into, rendered(F.col(html)))
