"""Visible text of HTML pages, laid out.

A tree builder reads the tags, adds those that HTML implies (a paragraph ends where a block begins, a list
item, cell, row or option where its like begins, text between rows moves into the flow) and never fails: end
tags without a start are ignored, open elements end with the page. Visibility rules drop what a browser
would not show: scripts, styles, the head, templates, hidden and closed elements, and what a ``style``
attribute or a simple rule (tag, class or id) of a style sheet hides; a visible part of an invisible one shows.
Style sheets and ``@media`` blocks count where they hold for every screen. What depends on a screen's width or
on another condition (``@supports``, ``@container``) or a scope doesn't count, so it hides nothing. The text of formulas,
drawings and image maps shows, but for what a drawing only defines (``defs``, ``symbol``) for ``use`` elsewhere.

What is visible is laid out as lines: blocks start lines, spaced ones (paragraphs, headings, lists, tables,
quotations) stand apart by one empty line; white space folds except in preformatted text; list items get
bullets or numbers and hang; the cells of a table stand in columns, padded to the widest cell, spans kept.

Pages are rows of their own: no shuffle, nothing shared. A null or empty page gives an empty text. Other columns
are ignored unless named in ``keep``. Elements may nest to any depth: open ones are kept in lists, none on Python's
stack. Text is never cut.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.cluster import prepare

TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
#: What may hold a brace or semicolon in a style sheet without being one, then those.
CSS_MARK = re.compile(r"\\.|\"(?:[^\"\\\n]|\\.)*\"?|'(?:[^'\\\n]|\\.)*'?|url\(\s*[^\s\"')][^)]*\)|[{};]", re.S | re.I)
MEDIUM = re.compile(r"(?:(only|not)\s+)?([a-z-]+)(\s+and\s.*)?", re.S)
BLANKS = re.compile(r"[ \t\n\r\f]+")

# Element names by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title plaintext".split())
HIDDEN = frozenset("head script style template noscript title meta link iframe object audio video canvas datalist noembed noframes rp annotation annotation-xml".split())
#: Elements of a drawing that show what is in them, and parts of its texts that don't show.
DRAWN = frozenset("svg g a switch".split())
SILENT = frozenset("desc metadata".split())
#: Parts of formulas that show their first part only, and those whose parts are set apart by blanks.
ONE_SHOWN = frozenset("maction semantics".split())
APART = frozenset("mfrac mtable mtr mlabeledtr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul xmp listing caption".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir xmp listing fieldset".split())
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "option", "optgroup", "legend", "caption"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start of the key ends an open one of the first set, looked for up to one of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup", "tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup", "tr"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup", "tr"}, {"table"}),
    "a": ({"a"}, {"table", "td", "th", "button", "object"}),
}
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup col".split())


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def tree(page: str) -> Node:
    """The tree of a page."""
    page = page.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    root = Node("#page", {})
    stack, at, n = [root], 0, len(page)
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements by tag, so that depth costs no search

    def end_from(i: int) -> None:
        while len(stack) > i:
            places[stack.pop().tag].pop()

    def last(tags: set[str] | frozenset[str]) -> int:
        """Place of the innermost open element of ``tags``, 0 if there is none."""
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close(tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        """End the highest open element of ``tags`` that lies inside the nearest of ``until``, and all in it."""
        if not any(places.get(tag) for tag in tags):
            return
        fence, found = last(until), len(stack)
        for tag in tags:
            held = places[tag]
            i = bisect_right(held, fence)
            if i < len(held):
                found = min(found, held[i])
        end_from(found)

    def foreign() -> bool:
        """Is the open element one of a drawing or formula?"""
        return last({"svg", "math"}) > last({"foreignobject", "desc", "annotation-xml"})

    def add_text(text: str) -> None:
        if text:
            stack[-1].children.append(html.unescape(text) if "&" in text else text)

    while at < n:
        found = TOKEN.search(page, at)
        if not found:
            add_text(page[at:])
            break
        add_text(page[at : found.start()])
        at = found.end()
        if page.startswith("<![CDATA[", found.start()) and foreign():
            stop = page.find("]]>", found.start())
            stack[-1].children.append(page[found.start() + 9 : stop if stop >= 0 else n])
            at = stop + 3 if stop >= 0 else n
            continue
        end, start, attributes = found.group(1), found.group(2), found.group(3)
        if end:
            end = end.lower()
            if end == "br":
                stack[-1].children.append(Node("br", {}))
            elif end in HEADINGS:
                close(HEADINGS, {"table", "td", "th"})
            else:
                fence = frozenset() if end in ("table", "html", "body") else {"table"} if end in TABLE_PARTS else {"td", "th", "caption", "table"} if end in BLOCKS else {"td", "th", "caption", "table", *({"p"} if end != "p" else ())} - {end}
                if end in ("html", "body"):
                    continue  # what follows still belongs to the page
                found = last({end})
                if found and found >= last(fence):
                    end_from(found)
        elif start:
            tag = start.lower()
            if tag in ENDS_PARAGRAPH:
                close({"p"}, {"td", "th", "caption", "table", "button"})
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                end_from(len(stack) - 1)
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            values = {}
            for m in ATTRIBUTE.finditer(attributes):
                name = m.group(1).lower()
                if name not in values:
                    value = m.group(2) or m.group(3) or m.group(4) or ""
                    values[name] = html.unescape(value) if "&" in value else value
            if tag == "body" or tag == "html":
                # One of each; the head ends where the body begins.
                close({"head"}, frozenset())
                if places[tag]:
                    continue
            elif stack[-1].tag == "head" and tag not in HIDDEN and tag not in ("base", "basefont", "bgsound"):
                end_from(len(stack) - 1)
            node = Node(tag, values)
            stack[-1].children.append(node)
            if tag in VOID or attributes.endswith("/") and (tag in ("svg", "math") or foreign()):
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])|\Z", re.I).search(page, at)
                text = page[at : stop.start()]
                if text:
                    node.children.append(html.unescape(text) if tag in ("title", "textarea") else text)
                close_at = page.find(">", stop.start())
                at = n if stop.start() == n or close_at < 0 else close_at + 1
            else:
                places[tag].append(len(stack))
                stack.append(node)
    return root


def _style(attributes: dict[str, str]) -> dict[str, str]:
    out = {}
    for part in attributes.get("style", "").lower().split(";"):
        name, colon, value = part.partition(":")
        if colon:
            out[name.strip()] = value.replace("!important", "").strip()
    return out


def on_screen(media: str) -> bool:
    """Does a list of media queries hold for every screen?"""
    if not media.strip():
        return True
    for query in media.lower().split(","):
        found = MEDIUM.fullmatch(query.strip())
        if found:
            kind, bound = found.group(2) in ("all", "screen"), found.group(3)
            if not kind if found.group(1) == "not" else kind and not bound:
                return True
    return False


def declarations(css: str) -> Iterator[tuple[str, str]]:
    """Selectors and one declaration of theirs each, of all that holds on every screen."""
    css = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S)
    blocks: list[tuple[str | None, bool]] = [(None, True)]  # open blocks: the selectors that they set, do they hold
    start = 0
    for mark in CSS_MARK.finditer(css + "}"):
        if mark.group() not in ("{", "}", ";"):
            continue
        selectors, holds = blocks[-1]
        head = css[start : mark.start()].strip()
        if selectors is None:
            head = re.sub(r"^(?:(?:<!--|-->)\s*)+", "", head)
        if mark.group() == "{":
            if head.startswith("@"):
                name, condition = re.fullmatch(r"@([\w-]*)(.*)", head, re.S).groups()
                blocks.append((selectors, holds and (name.lower() == "layer" or name.lower() == "media" and on_screen(condition))))
            else:
                blocks.append((head, holds) if selectors is None else ("", False))  # a rule in a rule is no simple one
        elif selectors is None and not head.startswith("@") and (mark.group() == ";" or len(blocks) == 1):
            continue  # no end: part of the selectors that follow
        else:
            if selectors is not None and holds and not head.startswith("@"):
                yield selectors, head
            if mark.group() == "}" and len(blocks) > 1:
                blocks.pop()
        start = mark.end()


class Sheet:
    """The simple rules of a page's style sheets: what they set of display and visibility."""

    def __init__(self, root: Node):
        self.rules: dict[str, dict[str, str]] = {}
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag == "style" and on_screen(node.attributes.get("media", "")):
                for selectors, body in declarations("".join(c for c in node.children if isinstance(c, str))):
                    found = {k: v for k, v in _style({"style": body}).items() if k in ("display", "visibility", "white-space")}
                    for selector in selectors.split(","):
                        if found and re.fullmatch(r"[.#]?[\w-]+", selector.strip()):
                            self.rules.setdefault(selector.strip(), {}).update(found)
            stack.extend(c for c in node.children if isinstance(c, Node))

    def of(self, node: Node) -> dict[str, str]:
        out: dict[str, str] = {}
        if self.rules:
            out.update(self.rules.get(node.tag, {}))
            for name in node.attributes.get("class", "").split():
                out.update(self.rules.get("." + name, {}))
            out.update(self.rules.get("#" + node.attributes.get("id", ""), {}))
        if "style" in node.attributes:
            out.update(_style(node.attributes))
        return out


def width_of(text: str) -> int:
    """Columns that a line takes: wide signs count two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Lines under construction: inline text flows into the last until a block ends it."""

    def __init__(self):
        self.done: list[str] = []
        self.open: list[str] = []  # parts of the last line, joined when it ends
        self.gap = 0  # empty lines owed before the next line
        self.space = False  # a folded blank is owed before the next word

    def flow(self, text: str) -> None:
        parts = BLANKS.split(text)
        for i, part in enumerate(parts):
            if i:
                self.space = True
            if part:
                if self.space and self.open:
                    self.open.append(" ")
                self.open.append(part)
                self.space = False

    def end(self, gap: int = 0) -> None:
        if self.open:
            self._owed()
            self.done.append("".join(self.open).rstrip(" "))
            self.open = []
        self.space = False
        self.gap = max(self.gap, gap)

    def _owed(self) -> None:
        if self.done:
            self.done.extend([""] * self.gap)
        self.gap = 0

    def put(self, lines: list[str]) -> None:
        """Whole lines as they are."""
        self.end()
        if lines:
            self._owed()
            self.done.extend(lines)

    def exactly(self, text: str) -> None:
        first, *rest = text.split("\n")
        if first:
            self.open.append(first)
        for line in rest:
            self._owed()
            self.done.append("".join(self.open))
            self.open = [line] if line else []


def _number(attributes: dict[str, str], name: str, default: int, least: int, most: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", attributes.get(name, ""))
    return min(most, max(least, int(found.group(1)))) if found else default


#: Yields the steps that it waits for, is sent what they return.
Steps = Generator["Steps", Any, Any]


def run_steps(first: Steps) -> Any:
    """What ``first`` returns; steps that wait for others are kept in a list."""
    waiting, result = [first], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(result))
            result = None
        except StopIteration as end:
            waiting.pop()
            result = end.value
    return result


class Renderer:
    def __init__(self, root: Node):
        self.sheet = Sheet(root)
        self.root = root

    def text(self) -> str:
        lines = run_steps(self.block(self.root, True, False))
        return "\n".join(line.rstrip(" ") for line in lines)

    def shown(self, node: Node, visible: bool) -> tuple[bool, bool, dict[str, str]]:
        """Is it laid out, is it visible, and its style."""
        style = self.sheet.of(node)
        out = node.tag in HIDDEN or style.get("display") == "none" or "hidden" in node.attributes and "display" not in style
        out = out or node.tag == "input" or node.tag == "dialog" and "open" not in node.attributes
        if node.tag == "mphantom":
            visible = False
        if style.get("visibility") in ("hidden", "collapse", "visible"):
            visible = style["visibility"] == "visible"
        return not out, visible, style

    def block(self, node: Node, visible: bool, exact: bool) -> Steps:
        """The lines of what is in a node."""
        out = Lines()
        yield self.into(out, node, visible, exact)
        out.end()
        return out.done

    def into(self, out: Lines, node: Node, visible: bool, exact: bool) -> Steps:
        number = _number(node.attributes, "start", 1, -(10**9), 10**9)
        step = 1
        if node.tag == "ol" and "reversed" in node.attributes:
            step = -1
            if "start" not in node.attributes:
                number = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
        closed = node.tag == "details" and "open" not in node.attributes
        for child in node.children:
            if isinstance(child, str):
                if visible and not closed and node.tag not in ("table", "tr", "tbody", "thead", "tfoot", "select", "colgroup", "optgroup"):
                    out.exactly(child) if exact else out.flow(child)
                elif visible and not closed and child.strip() and node.tag not in ("select", "optgroup", "colgroup"):
                    out.flow(child)  # text that stands between a table's parts
                continue
            laid, seen, style = self.shown(child, visible)
            if not laid or closed and child.tag != "summary":
                continue
            tag, display = child.tag, style.get("display", "")
            if tag in SILENT and node.tag in ("text", "tspan", "textpath"):
                continue
            if node.tag in ONE_SHOWN and child is not next(c for c in node.children if isinstance(c, Node)):
                break
            if node.tag in APART:
                out.space = True
            if tag == "math" and child.attributes.get("display", "").lower() == "block":
                display = display or "block"
            spaces = style.get("white-space", "")
            keeps = tag in ("pre", "textarea", "xmp", "listing") or spaces.startswith("pre") or exact and spaces not in ("normal", "nowrap")
            if tag == "br":
                if exact:
                    out.exactly("\n")
                elif out.open or out.done and not out.gap:
                    if out.open:
                        out.end()
                    else:
                        out.gap = max(out.gap, 1)
            elif tag == "wbr" or tag in ("img", "embed", "area"):
                pass
            elif tag == "svg":
                yield self.drawing(out, child, seen)
            elif tag == "select":
                options = list(_inside(child, "option"))
                for option in [c for c in options if "selected" in c.attributes] or options[:1]:
                    yield self.into(out, option, seen, False)
            elif tag == "table" and display in ("", "table", "inline-table"):
                out.end(1)
                out.put((yield self.table(child, seen)))
                out.end(1)
            elif tag == "li" or display == "list-item":
                marker = "- "
                if node.tag == "ol":
                    number = _number(child.attributes, "value", number, -(10**9), 10**9)
                    marker = f"{number}. "
                    number += step
                out.end()
                lines = yield self.block(child, seen, False)
                if lines:
                    out.put([marker + lines[0], *(" " * len(marker) + x if x else "" for x in lines[1:])])
            elif tag in ("blockquote", "dd"):
                gap = 1 if tag == "blockquote" else 0
                out.end(gap)
                lines = yield self.block(child, seen, False)
                out.put(["    " + x if x else "" for x in lines])
                out.end(gap)
            elif keeps and tag in BLOCKS or tag in ("pre", "xmp", "listing"):
                out.end(1)
                text = yield self.block(child, seen, True)
                while text and not text[0].strip():
                    text.pop(0)
                while text and not text[-1].strip():
                    text.pop()
                out.put(text)
                out.end(1)
            elif tag == "q":
                if seen:
                    out.flow("“")
                yield self.into(out, child, seen, exact)
                if seen:
                    out.space = False
                    out.flow("”")
            elif (tag in BLOCKS or tag in TABLE_PARTS or display in ("block", "flex", "grid", "table")) and not display.startswith("inline"):
                # Lists in a list don't stand apart.
                gap = 1 if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and node.tag == "li") else 0
                out.end(gap)
                yield self.into(out, child, seen, keeps)
                out.end(gap)
            else:
                yield self.into(out, child, seen, keeps)
        if node.tag in APART:
            out.space = True

    def drawing(self, out: Lines, node: Node, visible: bool) -> Steps:
        """The texts of a drawing, in their order, set apart by blanks."""
        for child in node.children:
            if isinstance(child, str) or child.tag not in DRAWN and child.tag not in ("text", "foreignobject"):
                continue
            laid, seen, style = self.shown(child, visible)
            # Attributes say the same where no style does.
            if not laid or "display" not in style and child.attributes.get("display", "") == "none":
                continue
            if "visibility" not in style and "visibility" in child.attributes:
                seen = child.attributes["visibility"] == "visible"
            if child.tag in DRAWN:
                yield self.drawing(out, child, seen)
            else:
                out.space = True
                yield self.into(out, child, seen, False)
                out.space = True
            if node.tag == "switch":
                break  # shows one of its parts

    def table(self, table: Node, visible: bool) -> Steps:
        """Captions, then the rows with their cells in columns, then what doesn't belong between rows."""
        captions, rows, last, loose = [], [], [], Lines()
        parts: list[tuple[Node, bool, list]] = [(table, visible, rows)]
        while parts:
            node, seen, to = parts.pop(0)
            strays = Node("#stray", {})
            for child in node.children:
                if isinstance(child, str):
                    strays.children.append(child)
                    continue
                laid, shows, _ = self.shown(child, seen)
                if not laid:
                    continue
                if child.tag == "caption":
                    captions += yield self.block(child, shows, False)
                elif child.tag in ("tbody", "thead", "tfoot"):
                    held = last if child.tag == "tfoot" else to
                    self._rows(child, shows, held, strays)
                elif child.tag == "tr":
                    to.append((child, shows))
                elif child.tag in ("td", "th"):
                    if not to or to[-1][0].tag != "#row":
                        to.append((Node("#row", {}), shows))
                    to[-1][0].children.append(child)
                elif child.tag not in ("colgroup", "col"):
                    strays.children.append(child)
            yield self.into(loose, strays, seen, False)
        loose.end()
        return captions + loose.done + (yield self._grid(rows + last))

    def _rows(self, part: Node, visible: bool, to: list, strays: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                strays.children.append(child)
                continue
            laid, seen, _ = self.shown(child, visible)
            if not laid:
                continue
            if child.tag == "tr":
                to.append((child, seen))
            elif child.tag in ("td", "th"):
                if not to or to[-1][0].tag != "#row":
                    to.append((Node("#row", {}), seen))
                to[-1][0].children.append(child)
            else:
                strays.children.append(child)

    def _grid(self, rows: list[tuple[Node, bool]]) -> Steps:
        taken: dict[int, int] = {}  # column: rows that a cell above still covers
        laid_rows: list[list[tuple[int, int, list[str], bool]]] = []
        for row, visible in rows:
            cells, column = [], 0
            for cell in row.children:
                if isinstance(cell, str):
                    if not cell.strip():
                        continue
                    stray = Node("td", {})
                    stray.children.append(cell)
                    cell = stray
                laid, seen, style = self.shown(cell, visible)
                if not laid:
                    continue
                while taken.get(column, 0) > 0:
                    column += 1
                # The largest spans that HTML allows.
                across = _number(cell.attributes, "colspan", 1, 1, 1000)
                down = _number(cell.attributes, "rowspan", 1, 0, 65534) or 65534
                right = "right" in (cell.attributes.get("align", "").lower(), style.get("text-align", ""))
                cells.append((column, across, (yield self.block(cell, seen, False)), right))
                for c in range(column, column + across):
                    taken[c] = max(taken.get(c, 0), down)
                column += across
            taken = {c: d - 1 for c, d in taken.items() if d > 1}
            laid_rows.append(cells)
        widths: dict[int, int] = {}
        for cells in laid_rows:
            for column, across, lines, _ in cells:
                if across == 1:
                    widths[column] = max(widths.get(column, 0), *map(width_of, lines), 0)
        # Columns that hold no text take no room.
        place, at = {}, 0
        for column in sorted(widths):
            place[column] = at
            at += widths[column] + 2 if widths[column] else 0
        out = []
        for cells in laid_rows:
            height = max((len(lines) for _, _, lines, _ in cells), default=0)
            for i in range(height):
                line, used = "", 0
                for column, across, lines, right in cells:
                    if i >= len(lines) or not lines[i]:
                        continue
                    start = place.get(column, used)
                    if right and across == 1 and width_of(lines[i]) <= widths.get(column, 0):
                        start += widths[column] - width_of(lines[i])
                    gap = max(start - used, 2 if line else 0)
                    line += " " * gap + lines[i]
                    used += gap + width_of(lines[i])
                out.append(line)
        return out


def _inside(node: Node, tag: str) -> Iterator[Node]:
    rest = node.children[::-1]
    while rest:
        child = rest.pop()
        if isinstance(child, Node):
            if child.tag == tag:
                yield child
            elif child.tag == "optgroup":
                rest += child.children[::-1]


def render(page: str | None) -> str:
    """The visible text of a page."""
    return Renderer(tree(page)).text() if page else ""


def render_pages(pages: DataFrame, page: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns and ``text``. A column text in ``keep`` raises a ValueError."""
    prepare(pages.sparkSession)
    kept = list(keep)
    if "text" in {c.lower() for c in kept}:
        raise ValueError("column text would come twice")
    schema = T.StructType([pages.schema[c] for c in kept] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x) for x in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(texts, pa.string())], names=[*kept, "text"])

    return pages.select(*kept, F.col(page).alias("__page")).mapInArrow(run, schema)
