"""HTML extraction by layout: a tree with implied tags, visibility rules, and a renderer that keeps blocks apart,
marks list items and aligns table cells.

Markup is read as browsers roughly do: tags that HTML implies are opened and closed, unknown end tags are
passed over, unclosed elements end with their parent, and the content of raw elements is no markup.
Hidden are scripts, styles, head matter, templates, what SVG and MathML do not draw (SVG text outside ``text``, definitions,
annotations), and elements with ``hidden``, ``aria-hidden="true"`` or a style of
``display:none`` or ``visibility:hidden``.  All other text is emitted in order: white space collapses outside
``pre``, block elements stand on lines of their own, paragraphs and headings with an empty line around them,
list items with a dash or their number, and the cells of a table in columns as wide as their widest cell, those that span columns or
rows included.  What stands in a table but in no cell or caption comes before the table, as in browsers; cells are found through it.
A table within a cell is part of the cell's one line.

Time and memory are in proportion to the page, whatever its markup: open elements are found by their tag, ends
of tags in one pass, and lists deeper than ``INDENTS`` are indented no further.

Cases: null or empty markup gives the empty text; markup without any tag is its own text; nested or broken tables and lists
render as far as they are there; elements nest to any depth; very long pages are steps of their own; repeated rows give repeated rows;
an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallystar.llm.common import per_text

NAME_END = re.compile(r"[\s/>]")
TAG_STOP = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACES = re.compile(r"[ \t\n\r\f]+")

#: Levels by which lists are indented at most.
INDENTS = 50

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset(
    "head script style title template noscript meta link base iframe object audio video canvas datalist".split()
)
#: Within SVG and MathML: what is not drawn, whose content is HTML again, and the HTML tags that end both.
UNDRAWN = frozenset(
    "defs symbol desc metadata clippath mask marker pattern lineargradient radialgradient filter annotation annotation-xml".split()
)
POINTS = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article aside nav header footer main address form fieldset legend details summary dialog "
    "dt dd li tr caption thead tbody tfoot figcaption option center menu".split()
)
#: Elements an opening tag closes where they are open, and the elements that stop the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: Parts of a table, which its cells lie in.
PARTS = frozenset("tr thead tbody tfoot colgroup col".split())
#: What an end tag does not reach across; those of table parts reach across cells.
TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
SCOPE = frozenset("table td th html body".split())
#: An unquoted value that ends in a slash, which closes nothing.
SLASH_VALUE = re.compile(r"""=\s*[^\s"'>=]*/\Z""")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    """An element; ``space`` is "svg", "text" (an SVG text and what is in it) or "math", and empty for HTML."""

    __slots__ = ("tag", "attributes", "children", "space")

    def __init__(self, tag: str, attributes: dict[str, str], space: str = ""):
        self.tag, self.attributes, self.children, self.space = tag, attributes, [], space

    def inner_space(self) -> str:
        return "" if self.tag in POINTS else self.space


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        quoted = value[1:-1] if value[:1] in ("'", '"') else value
        out.setdefault(name.lower(), html.unescape(quoted))
    return out


class Scanner:
    """Tags of a page, in one pass: whatever the markup, no stretch is searched again and again for the same end."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.found: dict[re.Pattern, tuple[int, int]] = {}
        self.broken: set[int] = set()

    def next(self, what: re.Pattern, at: int) -> int:
        """The first place of ``what`` from ``at`` on, or -1."""
        begin, place = self.found.get(what, (0, -2))
        if not (begin <= at and (at <= place or place == -1)):
            m = what.search(self.source, at)
            place = m.start() if m else -1
            self.found[what] = (at, place)
        return place

    def tag_end(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at ``at``, quoted ones passed over; -1 where there is none."""
        passed = []
        while True:
            place = self.next(TAG_STOP, at)
            if place >= 0 and self.source[place] == ">":
                return place
            close = -1
            if place >= 0 and place not in self.broken:
                passed.append(place)
                close = self.source.find(self.source[place], place + 1)
            if close < 0:
                # From any of these quotes on there is no end.
                self.broken.update(passed)
                return -1
            at = close + 1

    def token(self, at: int, foreign: bool) -> tuple[int, int, str, str, str]:
        """(start, end, slash, name, attributes) of the next tag from ``at`` on; of a comment or declaration
        without name, of character data in SVG or MathML the data in place of the attributes.  No start: (-1, ...)."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            at = start + 1
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(source), "", "", ""
            if foreign and source.startswith("<![CDATA[", start):
                end = source.find("]]>", start + 9)
                return start, end + 3 if end >= 0 else len(source), "", "", source[start + 9 : end if end >= 0 else len(source)]
            if start > self.last:
                break
            if source.startswith(("<!", "<?"), start):
                return start, source.find(">", start) + 1, "", "", ""
            slash = "/" if source.startswith("/", at) else ""
            head = at + len(slash)
            if not ("a" <= source[head : head + 1].lower() <= "z" and source[head : head + 1].isascii()):
                continue
            name_end = self.next(NAME_END, head)
            end = self.tag_end(name_end)
            if end >= 0:
                return start, end + 1, slash, source[head:name_end].lower(), source[name_end:end]
        return -1, len(source), "", "", ""


class Open(list):
    """The open elements, outermost first, and where those of each tag stand."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.at: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self))
        self.append(node)

    def cut(self, depth: int) -> None:
        """End the element at ``depth`` with all inside it."""
        while len(self) > depth:
            self.at[self.pop().tag].pop()

    def inner(self, tags: set[str] | frozenset) -> int:
        """Depth of the innermost open element of ``tags``, or 0."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)


def parse(source: str) -> Node:
    """The element tree of a page."""
    root = Node("html", {})
    open_ = Open(root)
    scan = Scanner(source)

    def close(tags: set[str] | frozenset, stop: frozenset | set) -> bool:
        """End the innermost open element of ``tags``, unless one of ``stop`` lies inside it."""
        depth = open_.inner(tags)
        if not depth or depth < open_.inner(stop):
            return False
        open_.cut(depth)
        return True

    def text(data: str) -> None:
        if open_[-1].tag == "head" and data.strip(" \t\n\r\f"):
            open_.cut(len(open_) - 1)  # the body begins
        if data and open_[-1].inner_space() != "svg":
            open_[-1].children.append(html.unescape(data) if "&" in data else data)

    at = 0
    while True:
        start, end, slash, tag, inside = scan.token(at, bool(open_[-1].space))
        text(source[at : start if start >= 0 else len(source)])
        at = end
        if start < 0:
            return root
        if not tag:
            if inside and open_[-1].inner_space() != "svg":
                open_[-1].children.append(inside)  # character data, where text is drawn
            continue
        if slash:
            if tag == "br":
                open_[-1].children.append(Node("br", {}))
            elif tag == "p" and not open_.inner({"p"}):
                open_[-1].children.append(Node("p", {}))
            elif tag not in ("html", "body"):
                close({tag}, {"table"} - {tag} if tag in TABLE else SCOPE - {tag})
            continue
        if tag == "html":
            root.attributes = attributes(inside) | root.attributes
            continue
        if tag in BREAKOUT:
            while open_[-1].inner_space():
                open_.cut(len(open_) - 1)
        if tag in BLOCKS and tag not in ("li", "tr", "td", "th"):
            close({"p"}, SCOPE | {"button"})
        if tag in CLOSES:
            # A row ends a cell and its row, a section ends all three.
            while close(*CLOSES[tag]):
                pass
        if tag in ("td", "th") and open_[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr", {})
            open_[-1].children.append(row)
            open_.push(row)
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" and re.fullmatch("h[1-6]", open_[-1].tag):
            open_.cut(len(open_) - 1)
        if open_[-1].tag == "head" and tag not in UNSEEN:
            open_.cut(len(open_) - 1)  # the body begins
        space = tag if tag in ("svg", "math") else open_[-1].inner_space()
        space = "text" if space == "svg" and tag == "text" else space
        node = Node(tag, attributes(inside) if inside.strip(" /") else {}, space)
        open_[-1].children.append(node)
        if space and inside.endswith("/") and not SLASH_VALUE.search(inside):
            continue  # closed by itself
        if tag in RAW:
            found = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
            raw = source[at : found.start() if found else len(source)]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = found.end() if found else len(source)
        elif tag not in VOID:
            open_.push(node)


def visible(node: Node) -> bool:
    a = node.attributes
    return not (
        node.tag in UNSEEN
        or "hidden" in a
        or a.get("aria-hidden", "").lower() == "true"
        or (node.tag == "input" and a.get("type", "").lower() == "hidden")
        or ("style" in a and HIDDEN_STYLE.search(a["style"]))
        or (node.space and (node.tag in UNDRAWN or a.get("display") == "none" or a.get("visibility") == "hidden"))
    )


class Page:
    """Lines of a rendering; ``gap`` is how many line ends are due before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.space = False
        self.prefix = ""

    def end_line(self, gap: int) -> None:
        if self.parts:
            self.lines.append("".join(self.parts).rstrip())
            self.parts = []
            self.gap = gap
        else:
            self.gap = max(self.gap, gap)
        self.space = False

    def write(self, data: str) -> None:
        if not self.parts:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
            self.parts.append(self.prefix)
            self.prefix = ""
            self.space = False
        elif self.space:
            self.parts.append(" ")
            self.space = False
        self.parts.append(data)

    def flow(self, data: str) -> None:
        """Text whose white space collapses."""
        words = SPACES.sub(" ", data)
        if words.startswith(" ") and self.parts:
            self.space = True
        body = words.strip(" ")
        if body:
            self.write(body)
            self.space = words.endswith(" ")

    def text(self) -> str:
        self.end_line(0)
        return "\n".join(self.lines)


def table_parts(table: Node) -> tuple[list[Node], list[list[Node]], list[object]]:
    """Captions, rows of cells, and all else that lies between these.  An element that does not belong there keeps
    what is no cell; its cells are the row's it stands in."""
    captions: list[Node] = []
    rows: list[list[Node]] = []
    strays: list[object] = []
    todo: list[tuple[object, list[Node] | None, list[object]]] = [(c, None, strays) for c in reversed(table.children)]
    while todo:
        node, row, loose = todo.pop()
        if isinstance(node, str) or node.tag == "table" or node.space:
            loose.append(node)
        elif node.tag in PARTS or node.tag in ("caption", "td", "th"):
            if not visible(node):
                continue
            if node.tag == "caption":
                captions.append(node)
            elif node.tag in PARTS:
                if node.tag == "tr":
                    row = []
                    rows.append(row)
                todo += [(c, row, loose) for c in reversed(node.children)]
            else:
                if row is None:
                    row = []
                    rows.append(row)
                row.append(node)
        elif node.tag not in UNSEEN:
            if row is None:
                row = []
                rows.append(row)
            rest = Node(node.tag, node.attributes)
            loose.append(rest)  # where it is hidden, its cells are not
            todo += [(c, row, rest.children) for c in reversed(node.children)]
    return captions, rows, strays


@dataclass
class Item:
    """The list that items stand in: its depth, and the next number of an ordered one."""

    depth: int
    number: int | None


def span(cell: Node, name: str, most: int) -> int:
    value = cell.attributes.get(name, "1")
    return min(most, int(value)) if re.fullmatch(r"[1-9]\d{0,5}", value) else 1


def placed(rows: list[list[Node]]) -> list[list[tuple[int, Node]]]:
    """The cells of each row with the columns they begin in, where cells span columns and rows.  Columns that no
    cell begins in are none."""
    taken: dict[int, int] = {}  # column -> rows it is still taken for
    out, starts = [], set()
    for row in rows:
        line, column, below = [], 0, {}
        for cell in row:
            while taken.get(column):
                column += 1
            line.append((column, cell))
            starts.add(column)
            wide, high = span(cell, "colspan", 1000), span(cell, "rowspan", 65534)
            for k in range(wide if high > 1 else 0):
                below[column + k] = high
            column += wide
        taken = {c: n - 1 for c, n in (taken | below).items() if n > 1}
        out.append(line)
    order = {c: k for k, c in enumerate(sorted(starts))}
    return [[(order[c], cell) for c, cell in line] for line in out]


def aligned(lines: list[list[tuple[int, str]]]) -> list[str]:
    """Lines of cells, each beginning where its column does.  A column is as wide as the widest of the cells that have another one
    behind them in the next column."""
    width: list[int] = []
    for line in lines:
        for (column, text), after in zip(line, [*(c for c, _ in line[1:]), None]):
            width += [0] * (column + 1 - len(width))
            if after is None or after == column + 1:
                width[column] = max(width[column], len(text))
    for line in lines:  # a cell over several columns widens the last of them
        for (column, text), (after, _) in zip(line, line[1:]):
            short = len(text) - sum(width[column:after]) - 2 * (after - column - 1)
            if after > column + 1 and short > 0:
                width[after - 1] += short
    begin = [0]
    for w in width:
        begin.append(begin[-1] + w + 2)
    out = []
    for line in lines:
        parts, at = [], 0
        for column, text in line:
            if text:
                parts.append(" " * (begin[column] - at) + text)
                at = begin[column] + len(text)
        if parts:
            out.append("".join(parts))
    return out


def render(root: Node, in_cell: bool = False) -> str:
    """All visible text of a tree.  A stack instead of recursion: elements nest to any depth.  In a cell, which
    is one line in the end, the cells of a table follow each other."""
    page = Page()
    todo: list[tuple[object, str, int, Item | None]] = [(root, "enter", 0, None)]
    while todo:
        node, doing, pre, item = todo.pop()
        if isinstance(node, str):
            if pre:
                head, *rest = node.split("\n")
                if head:
                    page.write(head)
                for line in rest:
                    if page.parts:
                        page.end_line(1)
                    elif page.lines:
                        page.lines.append("")
                    if line:
                        page.write(line)
            else:
                page.flow(node)
            continue
        if doing == "grid":
            captions, rows = node
            page.end_line(1)
            for caption in captions:
                page.flow(render_cell(caption))
                page.end_line(1)
            for line in aligned([[(k, render_cell(c)) for k, c in row] for row in placed(rows)]):
                page.write(line)
                page.end_line(1)
            continue
        tag = node.tag
        if doing == "leave":
            page.prefix = "" if tag == "li" else page.prefix
            page.end_line(2 if tag in PARAGRAPHS and not (item and tag in ("ul", "ol")) else 1)
            continue
        if not visible(node):
            continue
        if tag == "br":
            page.end_line(1) if page.parts else None
            continue
        if tag == "img":
            if node.attributes.get("alt"):
                page.flow(node.attributes["alt"])
            continue
        block = tag in BLOCKS
        if block:
            page.end_line(2 if tag in PARAGRAPHS and not (item and tag in ("ul", "ol")) else 1)
        if tag == "table":
            captions, rows, strays = table_parts(node)
            todo.append((node, "leave", pre, item))
            if in_cell:
                for cell in reversed([*captions, *(c for row in rows for c in row)]):
                    inner = Node("div", {})
                    inner.children = cell.children
                    todo.append((inner, "enter", 0, None))
            else:
                todo.append(((captions, rows), "grid", pre, item))
            # Text misplaced between the cells is still visible.
            todo += [(c, "enter", pre, item) for c in reversed(strays)]
            continue
        inner = item
        if tag in ("ol", "ul", "menu"):
            inner = Item(item.depth + 1 if item else 0, _whole(node.attributes.get("start"), 1) if tag == "ol" else None)
        elif tag == "li":
            indent = "  " * min(INDENTS, item.depth if item else 0)
            if item and item.number is not None:
                number = _whole(node.attributes.get("value"), item.number)
                page.prefix = f"{indent}{number}. "
                item.number = number + 1
            else:
                page.prefix = indent + "- "
        if block:
            todo.append((node, "leave", pre, item))
        deeper = pre + (tag == "pre")
        todo += [(c, "enter", deeper, inner) for c in reversed(node.children)]
        if tag in ("td", "th"):
            page.space = True
        if tag == "text" and node.space:
            # Each stands at a place of its own.
            page.space = bool(page.parts)
            todo.insert(len(todo) - len(node.children), (" ", "enter", 0, inner))
    return page.text()


def _whole(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"-?\d{1,9}", text) else otherwise


def render_cell(cell: Node) -> str:
    """A cell on one line."""
    inner = Node("div", {})
    inner.children = cell.children
    return SPACES.sub(" ", render(inner, in_cell=True)).strip()


def extract_text(source: str | None) -> str:
    return render(parse(source)) if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text): the visible text of each page."""
    return per_text(pages, [id_col], lambda sources: {"text": [extract_text(s) for s in sources]}, "text string", html_col)
