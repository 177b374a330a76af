"""Layout-aware rendering of HTML to text.

A page becomes a tree: void elements, raw-text elements, implied end tags (a
block ends an open paragraph, an item the item before it, a cell or row those
before them, text or a tag that isn't head content the head) and implied rows are built as a browser would for the page's text.
Rendering walks the tree and emits all visible text: white space is collapsed
outside ``pre``, blocks start lines, paragraphs, headings, lists and tables stand
between blank lines, list items carry markers and are indented, and the cells
of a table are padded so that its columns line up: a cell that spans rows keeps its
columns in those below, one that is wider than the columns it spans widens the last.

Not visible: ``head`` and its elements, scripts, styles, templates, fallback
content of embedded media, comments, elements with the ``hidden`` attribute or
an inline ``display: none``; text under an inline ``visibility: hidden`` unless
an element inside makes itself visible; what a closed ``details`` holds beside
its summary; hidden inputs.

Defined results: a null page renders as an empty text, as does one without
visible text. Elements nested deeper than ``DEEPEST`` become siblings, as in
browsers; their text stays. An unclosed tag at the end of a page is dropped.
Repeated rows each get a row, an empty table gives an empty result, other columns
are kept whatever their names, and no limit holds on a page's length.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.words import per_text

DEEPEST = 200

# Element names by their role.
VOID = set("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())  # what head may hold
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style title template noscript iframe noembed noframes object audio video canvas datalist "
             "meta link base area map param source track".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure fieldset hr".split())
BLOCKS = SPACED | set("address article aside body caption center dd details dialog dir div dt figcaption footer form header "
                      "hgroup html legend li main menu nav option optgroup search section summary tbody td tfoot th thead "
                      "tr".split())
ENDS_P = SPACED | set("address article aside center details dialog dir div figcaption footer form header hgroup main menu nav "
                      "search section summary li dd dt".split())
CELLS = {"td", "th"}
ROWS = {"tbody", "thead", "tfoot"}
# A start tag's implied ends: the open elements that it closes, and those beyond which it doesn't look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}), "tr": (CELLS | {"tr", "caption"}, {"table"} | ROWS),
    "tbody": (CELLS | ROWS | {"tr", "caption"}, {"table"}), "thead": (CELLS | ROWS | {"tr", "caption"}, {"table"}),
    "tfoot": (CELLS | ROWS | {"tr", "caption"}, {"table"}), "body": ({"head"}, {"html"}),
}
WALL = {"table", "caption", "template", "object", "button"} | CELLS  # ends of inner elements don't reach through

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|"
                 r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
# An attribute's name, and its value where it has one; an unclosed quote runs to the tag's end.
ATTRIBUTE = re.compile(r"""(=?[^\s/=]+|=)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s"'][^\s]*)?)?""")
BLANK = re.compile(r"[ \t\n\r\f]+")
VISIBILITY = re.compile(r"(?:^|;)visibility:([a-z]+)")
SHOWS = {"visible": True, "initial": True, "hidden": False, "collapse": False}  # any other value is the parent's


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []

    def rules(self) -> str:
        """The inline style, in lower case and without white space."""
        return BLANK.sub("", self.attrs.get("style", "").lower())

    def seen(self, rules: str, visible: bool) -> bool:
        """Whether its text shows, by the last declaration that says so."""
        for value in VISIBILITY.findall(rules):
            visible = SHOWS.get(value, visible)
        return visible

    def number(self, name: str, default: int) -> int:
        text = self.attrs.get(name, "").strip()
        return int(text) if text.isascii() and text.isdecimal() and len(text) < 10 else default


def attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name of a tag's attributes; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for name, text in ATTRIBUTE.findall(raw):
        if text[:1] in ("'", '"'):
            text = text[1:].removesuffix(text[0])
        found.setdefault(name.lower(), unescape(text))
    return found


def tree(html: str) -> Node:
    root = Node("html")
    stack, at, end = [root], 0, len(html)

    def close(tags, wall):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return True
            if stack[i].tag in wall:
                return False
        return False

    def leave_head():
        while stack[-1].tag == "head":
            stack.pop()

    while at < end:
        m = TAG.search(html, at)
        if at < (m.start() if m else end):
            text = unescape(html[at:m.start() if m else end])
            if text.strip(" \t\n\r\f"):
                leave_head()
            stack[-1].kids.append(text)
        if not m:
            break
        at = m.end()
        closing, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name or not m[0].endswith(">"):
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        tag = name.lower()
        if closing:
            if tag == "br":
                leave_head()
                stack[-1].kids.append(Node("br"))
            elif tag not in ("html", "body"):
                close({tag}, () if tag in WALL or tag in ROWS or tag == "tr" else WALL)
            continue
        if tag == "html" or tag == "head" and stack[-1].tag == "head":
            continue
        if tag not in HEAD:
            leave_head()
        if tag in ENDS_P:
            close({"p"}, WALL)
        if tag in CLOSES:
            tags, wall = CLOSES[tag]
            while close(tags, wall | ({"table"} if tag not in CELLS else set())):
                pass
        if tag in CELLS and stack[-1].tag in ROWS | {"table"}:
            stack[-1].kids.append(Node("tr"))
            stack.append(stack[-1].kids[-1])
        node = Node(tag, attributes(attrs) if attrs else None)
        stack[-1].kids.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
            text = html[at:stop.start() if stop else end]
            node.kids.append(unescape(text) if tag in ("textarea", "title") else text)
            at = stop.end() if stop else end
        elif tag not in VOID and len(stack) < DEEPEST:
            stack.append(node)
        if tag == "pre":  # a line end right behind the tag is no part of it
            at += 2 if html.startswith("\r\n", at) else html.startswith("\n", at)
    return root


class Flow:
    """Lines of one block container, as its content arrives."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a collapsed space is due before the next text

    def text(self, text: str) -> None:
        parts = BLANK.split(text)
        for i, part in enumerate(parts):
            if i:
                self.space = True
            if part:
                if self.space and self.line:
                    self.line.append(" ")
                self.line.append(part)
                self.space = False

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        self.space = False

    def blank(self) -> None:
        self.end_line()
        if self.lines and self.lines[-1]:
            self.lines.append("")

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def lines(node: Node, visible: bool = True, pre: bool = False) -> list[str]:
    """The rendered lines of a block container's content."""
    flow = Flow()
    count = node.number("start", 1) if node.tag == "ol" else 1
    shut = node.tag == "details" and "open" not in node.attrs

    def walk(kids, visible, pre):
        nonlocal count
        for kid in kids:
            if isinstance(kid, str):
                if shut or not visible:
                    continue
                if pre:
                    first, *rest = kid.split("\n")
                    flow.line.append(first)
                    for x in rest:
                        flow.lines.append("".join(flow.line).rstrip("\r"))
                        flow.line = [x]
                else:
                    flow.text(kid)
                continue
            tag, attrs = kid.tag, kid.attrs
            if tag in UNSEEN or shut and tag != "summary":
                continue
            seen = visible
            if attrs:
                rules = kid.rules()
                if "hidden" in attrs or "display:none" in rules:
                    continue
                seen = kid.seen(rules, visible)
            if tag == "br":
                if flow.line or not flow.lines or flow.lines[-1]:
                    flow.lines.append("".join(flow.line))
                flow.line, flow.space = [], False
            elif tag == "input":
                if seen and attrs.get("type", "").lower() in ("submit", "button", "reset"):
                    flow.text(attrs.get("value", ""))
            elif tag == "table":
                add(table(kid, seen), True)
            elif tag in BLOCKS:
                made = lines(kid, seen, pre or tag == "pre")
                if tag == "li":
                    count = kid.number("value", count)
                    mark = f"{count}. " if node.tag == "ol" else "- "
                    count += 1
                    made = [(mark if not i else " " * len(mark)) + x if x else x for i, x in enumerate(made)]
                elif tag in ("dd", "blockquote"):
                    made = ["  " + x if x else x for x in made]
                inner = tag in ("ul", "ol", "dl") and node.tag == "li"  # a nested list follows its item's line
                add(made, tag in SPACED and not inner)
            else:
                walk(kid.kids, seen, pre)

    def add(made, spaced):
        flow.blank() if spaced else flow.end_line()
        if made:
            flow.lines += made
            if spaced:
                flow.lines.append("")

    walk(node.kids, visible, pre)
    return flow.done()


def table(node: Node, visible: bool) -> list[str]:
    """A table's rows as lines, its columns padded to their widest cell."""
    before, rows, after = [], [], []

    def gather(kids, visible):
        for kid in kids:
            if isinstance(kid, str) or kid.tag in UNSEEN:
                if isinstance(kid, str) and kid.strip() and visible:
                    before.append(" ".join(kid.split()))  # text between cells stands above the table
                continue
            rules = kid.rules()
            if "hidden" in kid.attrs or "display:none" in rules:
                continue
            seen = kid.seen(rules, visible)
            if kid.tag == "tr":
                rows.append([])
                gather_cells(kid.kids, seen)
            elif kid.tag in ROWS:
                gather(kid.kids, seen)
            elif kid.tag not in ("col", "colgroup"):
                holder = Node("div")
                holder.kids = [kid]
                before.extend(lines(holder, visible))

    def gather_cells(kids, visible):
        for kid in kids:
            holder = Node("div")
            holder.kids = [kid]
            if isinstance(kid, Node) and kid.tag in CELLS:
                place(lines(holder, visible), min(max(kid.number("colspan", 1), 1), 1000), kid.number("rowspan", 1))
            else:
                after.extend(x for x in lines(holder, visible) if x)

    def place(made, span, down):
        """The next cell of the last row: at the first columns that are free."""
        at = rows[-1][-1][1] + rows[-1][-1][2] if rows[-1] else 0
        while held:
            taken = [c for c in range(at, at + span) if held.get(c, 0) >= len(rows)]
            if not taken:
                break
            at = taken[-1] + 1
        if down != 1:  # 0: to the table's end
            held.update((c, len(rows) + down - 1 if down else 1 << 30) for c in range(at, at + span))
        rows[-1].append((made, at, span))

    held: dict[int, int] = {}  # the last row in which a cell from above takes a column
    gather(node.kids, visible)
    widths: dict[int, int] = {}
    for made, at, span in sorted((cell for row in rows for cell in row), key=lambda cell: cell[2]):
        width = max(map(len, made), default=0)
        have = sum(widths.get(c, 0) for c in range(at, at + span)) + 2 * (span - 1)
        widths[at + span - 1] = widths.get(at + span - 1, 0) + max(0, width - have)
    left, x = {}, 0  # where each column begins
    for c in range(max(widths, default=0) + 1):
        left[c], x = x, x + widths.get(c, 0) + 2
    out = [*before]
    for row in rows:
        for i in range(max((len(made) for made, _, _ in row), default=0)):
            line = ""
            for made, at, _ in row:
                line = line.ljust(left[at]) + (made[i] if i < len(made) else "")
            out.append(line.rstrip())
    return [x for x in [*out, *after] if x]


def render(html: str) -> str:
    return "\n".join(lines(tree(html)))


def rendered(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``rendered``, the visible text of each whole page."""
    return per_text(pages, lambda texts: [pa.array([render(t.decode("utf-8", "replace")) for t in texts], pa.string())],
                    "rendered string", text=html)
