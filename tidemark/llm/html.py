"""Layout-aware HTML rendering: a tree builder with implied tags, then the visible text.

The tree follows the usual rules for omitted tags (p, li, dt/dd, option, table parts) and for stray end
tags; a head without an end tag ends at the first thing that is no head matter. Rendering gives blocks
lines of their own, paragraphs and headings a blank line around, lists bullets or numbers by depth,
preformatted text its spaces, and tables aligned columns; what lies loose in a table comes ahead of it.
Words of a cell wider than WRAP that has a neighbour on its right go on in lines below, within its column;
only a single longer word breaks the alignment of its line.

Text of svg and math, of text areas, and all options of a select (also those that show on opening only)
are visible. What a browser does not show is not emitted: head matter, scripts, styles, templates,
comments, the fallback in embedded media, closed details but their summary, and elements hidden by their
attributes or by the page's own style rules. Of those, selectors of a tag, classes and an id are read, in
order, the more special first; rules within at-rules and other selectors are not. Text inside an
invisible element that is made visible again is emitted. Attributes of input fields are left out.

Defined results: a null or blank page has empty text and no title; broken markup is read as far as it
goes, a tag that never ends being text; nesting deeper than MAX_DEPTH stays at that depth; a very long
page is read whole, in time in proportion to its length; repeated rows are rendered each; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 200
WRAP = 80

# fixed values of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link iframe object canvas audio video datalist noembed noframes".split())
#: Parts of svg and math that are not drawn.
UNDRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter annotation annotation-xml".split())
#: What an open head takes in; any other start tag ends it.
HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
CELLS = frozenset({"td", "th"})
BLOCK = frozenset("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table ul caption tr thead tbody tfoot xmp search".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table pre blockquote figure fieldset xmp".split())
#: A start tag ends these open elements, looking no further out than the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
ENDS_P = BLOCK - {"html", "body", "caption", "tr", "thead", "tbody", "tfoot", "legend"}
WALLS = {"table", "td", "th", "caption", "button", "object", "html"}

COMMENT = re.compile(r"<!--(?:.*?--!?>|.*\Z)", re.S)
OTHER = re.compile(r"<[!?][^>]*>")
CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*>")
#: A start tag; quotes count after an equals sign. BARE is for pages in which quotes never end.
OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>")
BARE = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)>")
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
DECLARED = re.compile(r"(display|visibility)\s*:\s*([a-z-]+)", re.I)
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)\Z")
GAPS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(page: str) -> Node:
    """The element tree of a page; children are nodes and strings."""
    root = Node("#root")
    stack = [root]
    at, n = 0, len(page)

    def close(tags: set[str], stop: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                # outer ones of the same set too: a row ends its cell and the row before
                return close(tags, stop)
            if stack[k].tag in stop:
                return None

    def add_text(text: str) -> None:
        if text:
            text = html.unescape(text)
            if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
                stack.pop()
            stack[-1].children.append(text)

    begin, last, quotes = 0, page.rfind(">"), True
    while at < n:
        at = page.find("<", at)
        if at < 0:
            break
        c, m = page[at + 1 : at + 2], None
        if page.startswith("<!--", at):
            m = COMMENT.match(page, at)
        elif at > last:
            break  # no tag ends any more
        elif c in ("!", "?"):
            m = OTHER.match(page, at)
        elif c == "/":
            m = CLOSE.match(page, at)
        elif c.isascii() and c.isalpha():
            m = OPEN.match(page, at) if quotes else None
            if not m:
                quotes, m = False, BARE.match(page, at)
        if not m:
            at += 1
            continue
        add_text(page[begin:at])
        begin = at = m.end()
        end, start, rest = m[1] if m.re is CLOSE else None, *(m.groups() if m.re in (OPEN, BARE) else (None, None))
        if end:
            tag = end.lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in WALLS and tag not in WALLS and tag not in {"tr", "thead", "tbody", "tfoot", "body"}:
                    break
            else:
                if tag == "p":
                    stack[-1].children.append(Node("p"))
                elif tag == "br":
                    stack[-1].children.append(Node("br"))
        elif start:
            tag = start.lower()
            if stack[-1].tag == "head" and tag not in HEAD:
                stack.pop()
            slash = bool(rest) and rest.endswith("/")
            foreign = (slash or tag in UNDRAWN) and (tag in ("svg", "math") or any(x.tag in ("svg", "math") for x in stack))
            ended = foreign and slash
            if tag in ENDS_P:
                close({"p"}, WALLS)
            if tag[0] == "h" and tag[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
                stack.pop()
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                row = Node("tr")
                stack[-1].children.append(row)
                stack.append(row)
            node = Node(tag, attributes(rest) if rest and not rest.isspace() else None)
            stack[-1].children.append(node)
            if foreign and tag in UNDRAWN:
                node.attrs["hidden"] = ""
            if tag in RAW and not ended:
                stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at, last + 1) if at <= last else None
                body = page[at : stop.start() if stop else n]
                begin = at = stop.end() if stop else n
                node.children.append(html.unescape(body) if tag in ("title", "textarea") else body)
            elif tag not in VOID and not ended and len(stack) < MAX_DEPTH:
                stack.append(node)
    add_text(page[begin:])
    return root


class Sheet:
    """Which elements a page's style rules hide or show."""

    def __init__(self, styles: list[str]):
        # by one of its names or its tag, then by all of them: the order and value of what was declared last
        self.rules: dict[str, dict[tuple[tuple[int, int, int], str, frozenset[str]], dict[str, tuple[int, str]]]] = {}
        order = 0
        for text in styles:
            text = outside_at_rules(re.sub(r"/\*.*?(?:\*/|\Z)", "", text, flags=re.S))
            for selectors, body in RULE.findall(text):
                said = declared(body)
                for selector in selectors.split(",") if said else []:
                    m = SELECTOR.match(selector.strip())
                    if m and m[0]:
                        names = frozenset(re.findall(r"[.#][\w-]+", m[2]))
                        tag = (m[1] or "*").lower()
                        ids = sum(x[0] == "#" for x in names)
                        at = min(names) if names else tag
                        own = self.rules.setdefault(at, {}).setdefault(((ids, len(names) - ids, int(tag != "*")), tag, names), {})
                        own |= {k: (order, v) for k, v in said.items()}
                        order += 1

    def of(self, node: Node) -> dict[str, str]:
        """display and visibility as declared for an element."""
        a = node.attrs
        said: dict[str, str] = {"display": "none"} if "hidden" in a else {}
        if self.rules:
            names = {"." + x for x in a.get("class", "").split()} | ({"#" + a["id"]} if a.get("id") else set())
            met = [(weight, own) for at in (*names, node.tag, "*") for (weight, tag, need), own in self.rules.get(at, {}).items() if tag in ("*", node.tag) and need <= names]
            best: dict[str, tuple] = {}
            for weight, own in met:
                for k, v in own.items():
                    best[k] = max(best.get(k, ()), (weight, *v))
            said |= {k: v[-1] for k, v in best.items()}
        return said | declared(a["style"]) if "style" in a else said


def declared(text: str) -> dict[str, str]:
    return {k.lower(): v.lower() for k, v in DECLARED.findall(text)}


def outside_at_rules(text: str) -> str:
    """Style rules that stand in no at-rule."""
    out, at, deep, skip = [], 0, 0, -1
    for m in re.finditer(r"@[^{};]*[{;]|[{}]", text):
        mark = m[0][-1]
        if skip < 0 and mark != m[0]:
            out.append(text[at : m.start()])
            skip = deep
        deep += {"{": 1, "}": -1, ";": 0}[mark]
        if skip >= 0 and deep <= skip:
            skip, at = -1, m.end()
    return "".join([*out, text[at:] if skip < 0 else ""])


def shown(node: Node, sheet: Sheet, visible: bool = True) -> None:
    """Take out of a tree what is not shown."""
    children: list[Node | str] = []
    for child in node.children:
        if isinstance(child, str):
            if visible:
                children.append(child)
            continue
        if child.tag in UNSEEN or child.tag == "input" or child.tag == "dialog" and "open" not in child.attrs:
            continue
        said = sheet.of(child) if child.attrs or sheet.rules else {}
        if said.get("display") == "none":
            continue
        own = said.get("visibility", "visible" if visible else "hidden") not in ("hidden", "collapse") if said.get("visibility") != "inherit" else visible
        if child.tag == "details" and "open" not in child.attrs:
            child.children = next(([x] for x in child.children if not isinstance(x, str) and x.tag == "summary"), [])
        shown(child, sheet, own)
        if own or child.children or child.tag == "br":
            children.append(child)
    node.children = children


def styles_of(node: Node) -> list[str]:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.tag == "style":
            out.append("".join(c for c in x.children if isinstance(c, str)))
        todo.extend(c for c in reversed(x.children) if not isinstance(c, str))
    return out


def width(text: str) -> int:
    """Columns that text takes in a fixed-width font."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Out:
    """Lines of text with collapsed space; `gap` is the blank lines due before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0
        self.space = False

    def text(self, text: str) -> None:
        parts = GAPS.split(text)
        if len(parts) > 1 and not parts[0]:
            self.space = True
        words = " ".join(filter(None, parts))
        if words:
            self.now.append((" " if self.space and self.now else "") + words)
            self.space = not parts[-1]

    def end(self, blank: bool = False) -> None:
        if self.now:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = 0
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        self.space = False
        self.gap = max(self.gap, int(blank))

    def block(self, lines: list[str], blank: bool) -> None:
        self.end(blank)
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.extend(lines)
            self.gap = int(blank)


def rendered(node: Node) -> list[str]:
    out = Out()
    fill(node, out)
    out.end()
    return out.lines


def fill(node: Node, out: Out) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
            continue
        tag = child.tag
        if tag == "br":
            if out.now:
                out.end()
            elif out.lines and not out.gap:
                out.lines.append("")
        elif tag == "hr":
            out.block(["---"], True)
        elif tag == "img":
            out.text(child.attrs.get("alt", ""))
        elif tag in ("ul", "ol", "menu"):
            out.block(listed(child), True)
        elif tag == "table":
            out.block(table(child), True)
        elif tag in ("pre", "xmp"):
            lines = raw_text(child).expandtabs().split("\n")
            out.block([x.rstrip() for x in (lines[1:] if lines and not lines[0].strip() else lines)], True)
        elif tag == "textarea":
            lines = raw_text(child).expandtabs().strip("\n").split("\n")
            out.block([x.rstrip() for x in lines] if any(map(str.strip, lines)) else [], False)
        elif tag in ("option", "optgroup", "select"):
            label = child.attrs.get("label", "") if tag != "select" else ""
            out.end()
            out.text(label)
            if tag != "option" or not label:
                out.end()
                fill(child, out)
            out.end()
        elif tag == "text":  # of a drawing: placed apart from its neighbours
            out.space = True
            fill(child, out)
            out.space = True
        elif tag in ("blockquote", "dd"):
            out.block(["  " + x if x else x for x in rendered(child)], tag == "blockquote")
        elif tag in BLOCK:
            out.end(tag in SPACED)
            fill(child, out)
            out.end(tag in SPACED)
        else:
            fill(child, out)


def listed(node: Node) -> list[str]:
    out: list[str] = []
    at = int(s) if node.tag == "ol" and (s := node.attrs.get("start", "1")).lstrip("-").isdecimal() and len(s) < 10 else 1
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                out.append(" ".join(GAPS.split(child)).strip())
            continue
        if child.tag in ("ul", "ol", "menu"):
            out += ["  " + x for x in listed(child)]
            continue
        mark = f"{at}. " if node.tag == "ol" else "- "
        body = [x for x in rendered(child)] or [""]
        at += child.tag == "li"
        if child.tag != "li":
            mark = ""
        out += [(mark if k == 0 else " " * len(mark) if x else "") + x for k, x in enumerate(body)]
    return [x.rstrip() for x in out]


def raw_text(node: Node) -> str:
    return "".join(c if isinstance(c, str) else "\n" if c.tag == "br" else raw_text(c) for c in node.children)


def span(node: Node, name: str, most: int) -> int:
    """A colspan or rowspan, within HTML's own limits."""
    text = node.attrs.get(name, "1").strip()
    return min(int(text), most) if text.isdecimal() and len(text) < 9 else 1


def wrapped(lines: list[str]) -> list[str]:
    """Lines of at most WRAP columns, but for longer words."""
    out: list[str] = []
    for line in lines:
        now, size = "", 0
        for word in line.split(" ") if width(line) > WRAP else [line]:
            n = width(word)
            if now and size + 1 + n > WRAP:
                out.append(now)
                now, size = word, n
            else:
                now, size = (f"{now} {word}", size + 1 + n) if now else (word, n)
        out.append(now)
    return out


def table(node: Node) -> list[str]:
    """Rows of aligned cells; a cell of several lines takes several; spans leave their places empty."""
    captions: list[str] = []
    rows: list[Node] = []
    loose = Node("#loose")

    def gather(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                loose.children.append(child)
            elif child.tag == "tr":
                rows.append(child)
                # cells and rows part the words beside them
                loose.children += [" ", *(x if isinstance(x, str) or x.tag not in CELLS else " " for x in child.children), " "]
            elif child.tag in ("thead", "tbody", "tfoot", "colgroup"):
                gather(child)
            elif child.tag == "caption":
                captions.extend(rendered(child))
            elif child.tag != "col":
                loose.children.append(child)

    gather(node)
    taken: list[dict[int, list[str]]] = []
    open_: list[tuple[int, int, int]] = []  # spans from the rows above: first column, column after, last row
    for r, row in enumerate(rows):
        open_ = sorted(x for x in open_ if x[2] >= r)
        place: dict[int, list[str]] = {}
        c, k, added = 0, 0, []
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in CELLS:
                continue
            while k < len(open_) and open_[k][0] <= c:
                c = max(c, open_[k][1])
                k += 1
            place[c] = rendered(cell)
            wide, deep = max(1, span(cell, "colspan", 1000)), span(cell, "rowspan", 65534) or len(rows)
            if deep > 1:
                added.append((c, c + wide, r + deep - 1))
            c += wide
        open_ += added
        last = max(place, default=-1)
        taken.append({c: x if c == last else wrapped(x) for c, x in place.items()})
    wide: dict[int, int] = {}
    for place in taken:
        for c, lines in place.items():
            wide[c] = max(wide.get(c, 0), min(WRAP, max(map(width, lines), default=0)))
    columns = sorted(wide)
    out = [*rendered(loose), *captions]
    for place in taken:
        # nothing stands right of a row's last cell
        last = max(place, default=-1)
        cells = [(wide[c], place.get(c, [])) for c in columns[: bisect.bisect_right(columns, last)]]
        for k in range(max((len(x) for _, x in cells), default=0)):
            parts = [(n, x[k] if k < len(x) else "") for n, x in cells]
            out.append("  ".join(x + " " * (n - width(x)) for n, x in parts).rstrip())
    return out


def title_of(node: Node) -> str | None:
    todo = [node]
    while todo:
        x = todo.pop()
        if x.tag == "title":
            return " ".join(GAPS.split("".join(c for c in x.children if isinstance(c, str)))).strip() or None
        if x.tag != "svg":
            todo.extend(c for c in reversed(x.children) if not isinstance(c, str))
    return None


def render(page: str | None) -> tuple[str | None, str]:
    """(title, visible text) of a page."""
    tree = parse((page or "").replace("\r\n", "\n").replace("\0", ""))
    title = title_of(tree)
    shown(tree, Sheet(styles_of(tree)))
    return title, "\n".join(rendered(tree)).strip("\n")


def extract(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """key, title, text, n_lines for every row of pages, without a shuffle."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render(x) for x in batch.column(1).to_pylist()]
            texts = [t.encode("utf-8", "replace").decode() for _, t in done]
            titles = [t and t.encode("utf-8", "replace").decode() for t, _ in done]
            lines = [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(titles, pa.string()), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], names=["page_id", "title", "text", "n_lines"])

    return pages.select(F.col(key).cast("long"), html).mapInArrow(each, "page_id long, title string, text string, n_lines long")
