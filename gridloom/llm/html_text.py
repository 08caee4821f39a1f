"""HTML to text with layout: a tree builder with implied tags, visibility rules, and a renderer for blocks, lists and tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import for_python, slices

# Element names of the HTML standard; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
TEXT_ONLY = frozenset("textarea title".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist svg math rp".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr legend li main menu nav ol optgroup option p pre search section summary table ul xmp caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure".split())
CLOSE_P = BLOCKS - {"html", "body", "option", "optgroup", "legend", "caption", "dd", "dt", "li"} | {"dd", "dt", "li"}
IN_HEAD = frozenset("base link meta title style script template noscript".split())
#: What an open element is closed by when another one begins: name -> (elements that end, elements beyond which none is looked for).
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **{k: ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for k in ("tbody", "thead", "tfoot", "caption", "colgroup")},
}
FORMATTING = frozenset("a b big code em font i nobr s small span strike strong sub sup tt u".split())
BARRIERS = frozenset("table td th caption button object template html body".split())

#: Widest column of a table that is padded; wider ones are only separated.
WIDEST = 40
#: Deepest nesting that is kept; elements below are siblings of the deepest one.
DEEPEST = 500

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|</[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!important\s*)?(?:;|$)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.attributes, self.children = name, attributes or {}, []


def attributes(rest: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        out.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return out


def parse(html: str) -> Node:
    """The tree of a page; end tags and elements that the standard implies are filled in, stray end tags are ignored."""
    root, head, body = Node("html"), Node("head"), Node("body")
    root.children += [head, body]
    stack: list[Node] = [root, head]

    def add(name: str, values: dict[str, str]) -> None:
        if name in ("html", "body"):
            (root if name == "html" else body).attributes |= values
        if name == "body" or stack[-1] is head and name not in IN_HEAD and name not in ("html", "head"):
            leave_head()
        if name in ("html", "head", "body"):
            return
        if name in CLOSE_P:
            end({"p"}, BARRIERS)
        if name in IMPLIED:
            end(*IMPLIED[name])
            table = next((n for n in reversed(stack) if n.name in ("table", "template")), None)
            if table is not None and table.name == "table":
                if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
                    add("tr", {})
        node = Node(name, values)
        stack[-1].children.append(node)
        if name not in VOID and len(stack) < DEEPEST:
            stack.append(node)

    def leave_head() -> None:
        if stack[1] is head:
            stack[1:] = [body]

    def end(names, barriers) -> None:
        """Close the outermost open element of `names` inside the nearest of `barriers`."""
        cut = None
        for i in range(len(stack) - 1, 1, -1):
            if stack[i].name in names:
                cut = i
            elif stack[i].name in barriers:
                break
        if cut is not None:
            del stack[cut:]

    def close(name: str) -> None:
        if name == "head":
            leave_head()
        if name == "br":
            add("br", {})
        if name == "p" and not any(n.name == "p" for n in stack):
            add("p", {})
        stop = {"table", "html", "body"} if name in ("tr", "td", "th", "tbody", "thead", "tfoot", "caption") else {"html", "body"} if name == "table" else BARRIERS
        for i in range(len(stack) - 1, 1, -1):
            if stack[i].name == name:
                # The end of a formatting element leaves the blocks that began inside it open.
                del stack[i:i + 1 if name in FORMATTING and any(n.name in BLOCKS for n in stack[i + 1:]) else None]
                return
            if stack[i].name in stop:
                return

    def text(s: str) -> None:
        if stack[-1] is head:
            if not s.strip():
                return
            leave_head()
        stack[-1].children.append(s)

    pos, n = 0, len(html)
    while pos < n:
        at = html.find("<", pos)
        if at < 0:
            at = n
        if at > pos:
            text(unescape(html[pos:at]))
        if at == n:
            break
        m = _TOKEN.match(html, at)
        if not m:
            text("<")
            pos = at + 1
            continue
        pos = m.end()
        if m["cdata"] is not None:
            text(m["cdata"])
        elif m["close"]:
            close(m["close"].lower())
        elif m["open"]:
            name, rest = m["open"].lower(), m["rest"]
            add(name, attributes(rest) if rest and "=" in rest or rest.strip(" /\n\t") else {})
            if name in RAW or name in TEXT_ONLY or name == "plaintext":
                stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, pos) if name != "plaintext" else None
                inner = html[pos:stop.start() if stop else n]
                if name not in RAW:
                    inner = unescape(inner)
                if stack[-1].name == name:
                    stack[-1].children.append(inner)
                    stack.pop()
                pos = html.find(">", stop.end()) + 1 if stop and html.find(">", stop.end()) >= 0 else n
    return root


def visible(node: Node) -> bool:
    a = node.attributes
    if node.name in HIDDEN or "hidden" in a and a["hidden"].lower() != "until-found":
        return False
    return "style" not in a or not _HIDING.search(a["style"])


class Flow:
    """Lines of a box: runs of text with collapsed space, breaks, and blank lines between spaced blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = False
        self.prefix = ""
        self.indent: list[str] = []

    def text(self, s: str, keep: bool) -> None:
        if keep:
            first, *rest = s.expandtabs(4).split("\n")
            self._add(first)
            for line in rest:
                self.line_end(force=True)
                self._add(line)
            return
        s = _SPACE.sub(" ", s)
        if s.startswith(" ") and (not self.open or self.open[-1].endswith(" ")):
            s = s[1:]
        self._add(s)

    def _add(self, s: str) -> None:
        if s:
            self.open.append(s)

    def line_end(self, force: bool = False) -> None:
        s = "".join(self.open).rstrip(" \t\n\r\f")
        self.open = []
        if not s and not force:
            return
        if self.gap and self.lines and self.lines[-1] and s:
            self.lines.append("")
        if s:
            self.gap = False
            lead = "".join(self.indent)
            if self.prefix:
                lead, self.prefix = lead[:len(lead) - len(self.prefix)] + self.prefix, ""
            s = lead + s
        self.lines.append(s)

    def block(self, spaced: bool) -> None:
        self.line_end()
        self.gap = self.gap or spaced

    def raw(self, lines: list[str]) -> None:
        self.line_end()
        for s in lines:
            self.open = [s]
            self.line_end(force=True)

    def result(self) -> list[str]:
        self.line_end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _table(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of cells (lines, columns spanned) as lines: columns begin at the same place unless a cell before is wider than `WIDEST`."""
    width: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                width[at] = max(width.get(at, 0), min(WIDEST, max(map(len, lines), default=0)))
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            parts, at = [], 0
            for lines, span in row:
                s = lines[k] if k < len(lines) else ""
                size = sum(width.get(c, 0) for c in range(at, min(at + span, len(width)))) + 3 * (min(span, max(1, len(width) - at)) - 1)
                parts.append(s.ljust(size))
                at += span
            line = " | ".join(parts).rstrip()
            if line.strip(" |"):
                out.append(line)
    return out


def render(root: Node) -> str:
    """All visible text of a tree in reading order."""
    flow = Flow()
    flows: list[Flow] = []
    tables: list[list[list[tuple[list[str], int]]]] = []
    lists: list[list] = []
    pre = 0
    todo: list = [(root, False)]
    while todo:
        node, leave = todo.pop()
        if isinstance(node, str):
            flow.text(node, pre > 0)
            continue
        name = node.name
        if not leave:
            if not visible(node):
                continue
            if name in ("br",):
                flow.line_end(force=bool(flow.lines))
                continue
            if name == "wbr":
                continue
            if name == "img":
                flow.text(node.attributes.get("alt", ""), False)
                continue
            if name == "input":
                if node.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel"):
                    flow.text(node.attributes.get("value", ""), False)
                continue
            if name in BLOCKS:
                flow.block(name in SPACED and not (name in ("ul", "ol") and lists))
            if name in ("ul", "ol", "menu"):
                start = node.attributes.get("start", "1")
                lists.append([name == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif name == "li":
                ordered, number = lists[-1] if lists else (False, 0)
                mark = f"{number}. " if ordered else "- "
                if lists:
                    lists[-1][1] += 1
                flow.indent.append(" " * len(mark))
                flow.prefix = mark
            elif name in ("blockquote", "dd"):
                flow.indent.append("  ")
            elif name in ("pre", "textarea", "xmp"):
                pre += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\n")
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(flow)
                flow = Flow()
                lists.append([False, 0])
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children))
            continue
        if name in ("td", "th") and tables and flows:
            cell = flow.result()
            flow = flows.pop()
            lists.pop()
            span = node.attributes.get("colspan", "1")
            tables[-1][-1].append((cell, min(100, max(1, int(span))) if re.fullmatch(r"\d{1,4}", span) else 1))
        elif name == "table":
            flow.raw(_table(tables.pop()))
        if name in ("ul", "ol", "menu"):
            lists.pop()
        elif name == "li":
            flow.line_end()
            flow.indent.pop()
            flow.prefix = ""
        elif name in ("blockquote", "dd"):
            flow.line_end()
            flow.indent.pop()
        elif name in ("pre", "textarea", "xmp"):
            flow.line_end()
            pre -= 1
        if name in BLOCKS:
            flow.block(name in SPACED and not (name in ("ul", "ol") and lists))
    return "\n".join(flow.result())


def title_of(root: Node) -> str | None:
    """The text of the first title element of the head."""
    for node in root.children[0].children + root.children[1].children:
        if isinstance(node, Node) and node.name == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
    return None


def extract(pages: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """``(id, title, text)`` per row: the page's title and all its visible text.

    Blocks are lines, spaced blocks have a blank line around them; list items begin with a dash or their number and nested ones are
    indented; the cells of a table's row stand beside each other, columns padded up to `WIDEST`; `pre` keeps its space.  Null html gives null
    text, empty html empty text; broken html gives the text of the tree that the rules build.  Repeated rows and null ids stay; an empty
    table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            titles, texts = [], []
            for h in batch.column(1).to_pylist():
                root = None if h is None else parse(h)
                titles.append(None if root is None else title_of(root))
                texts.append(None if root is None else render(root))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string())], ["id", "title", "text"])

    kind = pages.schema[id].dataType.simpleString()
    rows = pages.select(F.col(id).alias("id"), F.col(html).alias("html"))
    return for_python(rows).mapInArrow(run, f"id {kind}, title string, text string").withColumnRenamed("id", id)
