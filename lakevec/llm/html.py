"""HTML extraction by layout-aware rendering.

A tree builder reads any markup, adds the tags that HTML implies (paragraphs ended by blocks, list items, table parts,
options) and ignores end tags that close nothing. A renderer walks the tree: rules of visibility (elements that are
never shown, ``hidden``, closed details and dialogs, inline styles and simple rules of style sheets) decide what is
seen; blocks stand on lines of their own, those with a margin after a blank line; list items have their markers and
are indented; table cells are aligned in columns, spans included; formulas and the text of drawings are read in the
order of the source. All visible text comes out, nothing is ranked or cut.
"""

from __future__ import annotations

import html as entities
import re
import sys
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_texts

#: Elements nested deeper become siblings, as in browsers.
DEPTH = 512
#: Columns are as wide as their widest line, up to this; a line beyond it is written whole.
WIDEST = 1000
#: Largest span of a cell, as browsers have it for columns.
SPAN = 1000

# fixed values: the element classes of HTML
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes xmp textarea title".split())
NEVER = frozenset("head script style title template datalist iframe noembed noframes object video audio canvas rp".split())
MARGIN = frozenset("address blockquote center dl fieldset figure form h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp listing plaintext dir".split())
BLOCK = MARGIN | frozenset("article aside body caption dd details dialog div dt figcaption footer header hgroup html legend li main nav optgroup search section summary tbody td tfoot th thead tr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul xmp listing plaintext".split())
#: What HTML ends an svg or a math element by; what is never shown in one; where HTML begins again in them.
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
NEVER_DRAWN = NEVER | frozenset("annotation annotation-xml clippath defs desc filter lineargradient marker mask metadata mphantom pattern radialgradient symbol".split())
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mn mo ms mtext".split())
TABLE_PARTS = frozenset("caption colgroup tbody thead tfoot tr td th".split())
#: Where only table parts can stand; other content is shown before the table, but for what stays though it is no part.
ROWS = frozenset("table tbody thead tfoot tr colgroup".split())
STAYS = TABLE_PARTS | frozenset("col form script style template".split())
#: The parts that a table part lies in; what is open above them is closed.
WITHIN = {"td": ("tr",), "th": ("tr",), "tr": ("tbody", "thead", "tfoot")}
#: What a start tag closes, and where looking for it stops.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("optgroup", "option"), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("tbody", "thead", "tfoot", "table")),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "rt": (("rt", "rp"), ("ruby",)),
    "rp": (("rt", "rp"), ("ruby",)),
}
SCOPE = frozenset("td th caption table button object template html body".split())

_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<bogus>[!?][^>]*(?:>|\Z))|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(?:>|\Z))",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CLOSED = re.compile(r"(?:\A|[\s\"']|\s[^\s=\"']+)/\Z")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
_WHITE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "kids", "depth", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], depth: int, parent: Node | None = None):
        self.tag, self.attrs, self.kids, self.depth, self.parent = tag, attrs, [], depth, parent


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        name = m[1].lower()
        if name not in out:
            value = next((x for x in m.groups()[1:] if x is not None), "")
            out[name] = entities.unescape(value) if "&" in value else value
    return out


class Builder:
    def __init__(self):
        self.root = Node("#root", {}, 0)
        self.stack = [self.root]
        self.css: list[str] = []
        self.open: dict[str, int] = {}

    def push(self, tag: str, raw: str = "") -> Node:
        parent = self.stack[-1]
        moved = parent.tag in ROWS and tag not in STAYS
        if moved:
            parent = self.around_table()
        node = Node(tag, attributes(raw) if raw and not raw.isspace() else {}, parent.depth + 1, parent)
        parent.kids.insert(len(parent.kids) - moved, node)
        if tag == "form" and parent.tag in ROWS:
            return node  # the rows and cells after it are the table's
        if tag not in VOID and node.depth < DEPTH:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
        return node

    def around_table(self) -> Node:
        """The parent of the innermost open table, which is its last child."""
        return self.stack[max(i for i, x in enumerate(self.stack) if x.tag == "table") - 1]

    def pop_to(self, at: int) -> None:
        for node in self.stack[at:]:
            self.open[node.tag] -= 1
        del self.stack[at:]

    def find(self, tags, stops) -> int:
        """The place on the stack of the innermost of ``tags`` within ``stops``; 0 if there is none."""
        if not any(self.open.get(t) for t in tags):
            return 0
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                return i
            if tag in stops:
                return 0
        return 0

    def foreign(self) -> int:
        """The place on the stack of the svg or math element whose own elements are read; 0 if it is HTML."""
        if not (self.open.get("svg") or self.open.get("math")):
            return 0
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in ("svg", "math"):
                return i
            if self.stack[i].tag in INTEGRATION:
                return 0
        return 0

    def start(self, tag: str, raw: str) -> Node | None:
        if at := self.foreign():
            if tag in BREAKS_OUT:
                self.pop_to(at)
                return self.start(tag, raw)
            if tag not in TABLE_PARTS and tag != "html":
                return self.push(tag, raw)
        if tag in ("html", "body"):
            if self.open.get(tag):
                return None
            if tag == "body" and self.open.get("head") and (at := self.find(("head",), ())):
                self.pop_to(at)
        elif tag not in ("head", "meta", "link", "base", "title", "script", "style", "template", "noscript") and self.open.get("head"):
            self.pop_to(self.find(("head",), ()))  # the body begins without its tag
        if tag in ENDS_P and self.open.get("p") and (at := self.find(("p",), SCOPE)):
            self.pop_to(at)
        if tag in CLOSES:
            tags, stops = CLOSES[tag]
            if at := self.find(tags, (*stops, "table") if tag not in ("tbody", "thead", "tfoot") else stops):
                self.pop_to(at)
        if tag in TABLE_PARTS:
            if not self.open.get("table"):
                return None  # a part without a table is no element
            if tag in ("td", "th") and not self.find(("tr",), ("table",)):
                self.start("tr", "")
            if tag == "tr":
                at = self.find(("caption", "colgroup"), ("table",))
                if at:
                    self.pop_to(at)
                if not self.find(("tbody", "thead", "tfoot"), ("table",)):
                    self.start("tbody", "")
            if tag in WITHIN:
                at = self.find(WITHIN[tag], ("table",))
            else:
                at = self.find(("table",), ("td", "th", "caption"))
            if at:
                self.pop_to(at + 1)
        elif tag == "table":
            if at := self.find(("table",), ("td", "th", "caption")):
                self.pop_to(at)  # no table lies between the parts of another
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.pop_to(len(self.stack) - 1)
        elif tag in ("a", "button") and self.open.get(tag) and (at := self.find((tag,), SCOPE - {"button"})):
            self.pop_to(at)
        return self.push(tag, raw)

    def end(self, tag: str) -> None:
        if tag == "br":
            if at := self.foreign():
                self.pop_to(at)
            self.push("br")
        elif tag == "p" and not self.find(("p",), SCOPE):
            self.start("p", "")
            self.pop_to(len(self.stack) - 1) if self.stack[-1].tag == "p" else None
        elif tag in ("html", "body"):
            return  # what follows belongs to the body all the same
        else:
            headings = ("h1", "h2", "h3", "h4", "h5", "h6")
            tags = headings if tag in headings else (tag,)
            stops = ("table",) if tag in TABLE_PARTS else () if tag == "table" else SCOPE - {tag}
            if at := self.find(tags, stops):
                self.pop_to(at)

    def text(self, text: str) -> None:
        if self.stack[-1].tag in ROWS and text.strip(" \t\n\r\f"):
            # text between table parts is shown before the table
            kids = self.around_table().kids
            kids.insert(len(kids) - 1, text)
        else:
            if self.open.get("head") and self.stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
                self.pop_to(self.find(("head",), ()))
            self.stack[-1].kids.append(text)


def parse(source: str) -> tuple[Node, list[str]]:
    """The tree and the texts of its style sheets."""
    b, at, end = Builder(), 0, len(source)
    while at < end:
        lt = source.find("<", at)
        m = None
        while lt >= 0 and not (m := _TAG.match(source, lt)):
            lt = source.find("<", lt + 1)
        if lt != at:
            text = source[at : lt if lt >= 0 else end]
            b.text(entities.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m["bogus"] and source.startswith("<![CDATA[", lt) and (b.foreign() or b.stack[-1].tag in INTEGRATION):
            stop = source.find("]]>", lt)
            b.text(source[lt + 9 : stop if stop >= 0 else end])
            at = stop + 3 if stop >= 0 else end
        elif m["end"]:
            b.end(m["end"].lower())
        elif m["start"]:
            tag = m["start"].lower()
            closes = (b.foreign() and tag not in BREAKS_OUT or tag in ("svg", "math")) and _CLOSED.search(m["attrs"])
            node = b.start(tag, m["attrs"].rstrip("/"))
            if closes:
                if b.stack[-1] is node:
                    b.pop_to(len(b.stack) - 1)
                continue
            if tag == "plaintext" and node:
                node.kids.append(source[at:])
                break
            if tag in RAW:
                close = _closer(tag).search(source, at)
                body = source[at : close.start() if close else end]
                at = close.end() if close else end
                if tag == "style":
                    b.css.append(body)
                elif node and tag in ("textarea", "xmp"):
                    node.kids.append(entities.unescape(body) if tag == "textarea" else body)
                if node and b.stack[-1] is node:
                    b.pop_to(len(b.stack) - 1)
    return b.root, b.css


@lru_cache(maxsize=None)
def _closer(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I)


def style_of(declarations: str) -> dict[str, str]:
    out = {}
    for part in declarations.split(";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if colon and name in ("display", "visibility", "white-space"):
            out[name] = value.replace("!important", "").strip().lower()
    return out


def presentation(node: Node) -> dict[str, str]:
    """Style that an element of a drawing or formula has by its attributes."""
    names = ("visibility",) if node.tag == "math" else ("display", "visibility")
    return {k: node.attrs[k].strip().lower() for k in names if k in node.attrs}


class Compound(NamedTuple):
    """One element of a selector; ``child``: the one before it is its parent, not just above it."""

    tag: str
    classes: frozenset[str]
    ids: frozenset[str]
    child: bool

    def fits(self, node: Node) -> bool:
        return (not self.tag or self.tag == node.tag) and (not self.ids or self.ids == {node.attrs.get("id")}) and self.classes <= set(node.attrs.get("class", "").split())


class Rule(NamedTuple):
    weight: tuple[int, int, int, int]
    parts: tuple[Compound, ...]
    style: dict[str, str]

    def fits(self, node: Node | None, upto: int = -1) -> bool:
        """Whether the parts up to ``upto`` (the last one, if not given) lead to ``node``."""
        at = len(self.parts) - 1 if upto < 0 else upto
        if not self.parts[at].fits(node):
            return False
        if at == 0:
            return True
        above = node.parent
        while above is not None and above.tag != "#root":
            if self.fits(above, at - 1):
                return True
            if self.parts[at].child:
                return False
            above = above.parent
        return False


def selector(text: str) -> tuple[Compound, ...] | None:
    parts, child = [], False
    for x in text.replace(">", " > ").split():
        if x == ">":
            child = True
            continue
        m = _COMPOUND.fullmatch(x)
        if not m:
            return None
        names = re.findall(r"[.#][\w-]+", m[2])
        tag = "" if m[1] in (None, "*") else m[1].lower()
        parts.append(Compound(tag, frozenset(n[1:] for n in names if n[0] == "."), frozenset(n[1:] for n in names if n[0] == "#"), child))
        child = False
    return tuple(parts) if parts and not child else None


def sheet(texts: list[str]) -> dict[str, list[Rule]]:
    """Rules by a name that the element must have: an id, a class or a tag (``*``: any).

    Selectors of tags, classes and ids with descendant and child steps are followed; at-rules and all others are passed
    over. Heavier rules come later, then those that stand later.
    """
    out: dict[str, list[Rule]] = {}
    for text in texts:
        text = re.sub(r"/\*.*?(?:\*/|\Z)", "", text, flags=re.S)
        text = re.sub(r"@[^{;]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\}?)", "", text)
        for selectors, declarations in _RULE.findall(text):
            if style := style_of(declarations):
                for s in selectors.split(","):
                    if parts := selector(s):
                        last = parts[-1]
                        weight = (sum(len(p.ids) for p in parts), sum(len(p.classes) for p in parts), sum(bool(p.tag) for p in parts), sum(map(len, out.values())))
                        name = next(iter(sorted(f"#{x}" for x in last.ids)), None) or next(iter(sorted(f".{x}" for x in last.classes)), None) or last.tag or "*"
                        out.setdefault(name, []).append(Rule(weight, parts, style))
    return out


def width(text: str) -> int:
    """Columns that a text takes: wide characters two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines in the making."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False

    def add(self, text: str, pre: bool = False) -> None:
        if pre:
            first, *more = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for x in more:
                self.newline(always=True)
                self._put(x)
            return
        words = _WHITE.sub(" ", text)
        if not words:
            return
        if words[0] == " ":
            self.space = self.space or bool(self.line)
            words = words[1:]
        if not words:
            return
        after = words[-1] == " "
        self._put(words[:-1] if after else words)
        self.space = after

    def _put(self, text: str) -> None:
        if text:
            if not self.line and self.gap:
                if self.lines:
                    self.lines.append("")
                self.gap = False
            if self.space:
                self.line.append(" ")
            self.space = False
            self.line.append(text)

    def newline(self, always: bool = False) -> None:
        if self.line or always:
            self.lines.append("".join(self.line).rstrip(" \t"))
        self.line, self.space = [], False

    def margin(self) -> None:
        self.newline()
        self.gap = True

    def block(self, lines: list[str]) -> None:
        self.newline()
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.extend(lines)

    def done(self) -> list[str]:
        self.newline()
        return self.lines


class Renderer:
    def __init__(self, css: dict[str, list[Rule]]):
        self.css = css

    def style(self, node: Node) -> dict[str, str]:
        attrs, css, out = node.attrs, self.css, {}
        if css:
            names = (node.tag, "*", f"#{attrs.get('id', '')}", *(f".{c}" for c in set(attrs.get("class", "").split())))
            for rule in sorted((r for n in names for r in css.get(n, ()) if r.fits(node)), key=lambda r: r.weight):
                out.update(rule.style)
        if attrs:
            if "hidden" in attrs and "display" not in out:
                out = {**out, "display": "none"}
            if "style" in attrs:
                out = {**out, **style_of(attrs["style"])}
        return out

    def lines(self, node: Node, seen: bool, pre: bool) -> list[str]:
        flow = Flow()
        self.walk(node, flow, seen, pre)
        return flow.done()

    def walk(self, node: Node, flow: Flow, seen: bool, pre: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                if seen:
                    flow.add(kid, pre)
            else:
                self.element(kid, flow, seen, pre)

    def element(self, node: Node, flow: Flow, seen: bool, pre: bool) -> None:
        tag = node.tag
        if tag in NEVER:
            return
        style = self.style(node) if node.attrs or self.css else {}
        if tag == "svg":
            style = presentation(node) | style
        display = style.get("display", "")
        if display == "none":
            return
        if "visibility" in style:
            seen = style["visibility"] not in ("hidden", "collapse")
        if "white-space" in style:
            pre = style["white-space"] in ("pre", "pre-wrap", "break-spaces")
        if tag in ("svg", "math"):
            apart = display == "block" or node.attrs.get("display") == "block"
            flow.newline() if apart else None
            self.drawing(node, flow, seen, pre, tag == "math")
            flow.newline() if apart else None
        elif tag == "br":
            flow.newline(always=True) if seen else None
        elif tag == "hr":
            flow.margin()
        elif tag == "input":
            kind = node.attrs.get("type", "text").lower()
            value = node.attrs.get("value", {"submit": "Submit", "reset": "Reset"}.get(kind, ""))
            if seen and kind not in ("hidden", "checkbox", "radio", "color", "range", "file", "image", "password") and value:
                flow.add(value)
        elif tag == "select":
            if seen:
                flow.add(self.chosen(node))
        elif tag == "table":
            flow.margin()
            flow.block(self.table(node, seen, pre))
            flow.margin()
        elif tag in ("ul", "ol", "menu", "dir"):
            nested = node.depth > 1 and flow.gap is False and getattr(flow, "item", False)
            flow.newline() if nested else flow.margin()
            self.items(node, flow, seen, pre)
            flow.newline() if nested else flow.margin()
        elif tag == "dialog" and "open" not in node.attrs:
            return
        elif tag == "details" and "open" not in node.attrs:
            flow.newline()
            first = next((k for k in node.kids if isinstance(k, Node) and k.tag == "summary"), None)
            if first:
                self.walk(first, flow, seen, pre)
            flow.newline()
        elif tag in ("pre", "xmp", "listing", "plaintext", "textarea"):
            inner = Flow()
            if node.kids and isinstance(node.kids[0], str) and node.kids[0][:1] == "\n":
                node.kids[0] = node.kids[0][1:]
            self.walk(node, inner, seen, style.get("white-space") not in ("normal", "nowrap", "pre-line"))
            lines = inner.done()
            flow.margin() if tag != "textarea" else flow.newline()
            flow.block(lines)
            flow.margin() if tag != "textarea" else flow.newline()
        elif tag in ("blockquote", "dd"):
            flow.margin() if tag == "blockquote" else flow.newline()
            flow.block(["  " + x if x else x for x in self.lines(node, seen, pre)])
            flow.margin() if tag == "blockquote" else flow.newline()
        elif (tag in BLOCK and not display.startswith("inline")) or display in ("block", "flex", "grid", "list-item", "table", "flow-root"):
            # a paragraph has a margin however it is styled, as no margins are read
            edge = flow.margin if tag in MARGIN else flow.newline
            edge()
            if tag == "li":  # outside of a list
                flow.add("- ") if seen else None
            self.walk(node, flow, seen, pre)
            edge()
        else:
            self.walk(node, flow, seen, pre)

    def drawing(self, node: Node, flow: Flow, seen: bool, pre: bool, text: bool) -> None:
        """The text of a formula, or of the text elements and HTML parts of a drawing; ``text``: whether in one."""
        kids = node.kids
        if node.tag == "switch":  # the first that asks for nothing
            kids = [k for k in kids if isinstance(k, Node) and not {"systemlanguage", "requiredextensions"} & k.attrs.keys()][:1]
        for kid in kids:
            if isinstance(kid, str):
                if text and seen:
                    flow.add(kid, pre)
                continue
            tag = kid.tag
            if tag in BREAKS_OUT:
                self.element(kid, flow, seen, pre)
                continue
            style = presentation(kid) | self.style(kid)
            if tag in NEVER_DRAWN or style.get("display") == "none":
                continue
            shown = style["visibility"] not in ("hidden", "collapse") if "visibility" in style else seen
            if tag == "mtd" or node.tag == "mfrac":
                flow.space = flow.space or bool(flow.line)
            apart = tag in ("text", "foreignobject", "mtr", "mlabeledtr") or (tag == "tspan" and "x" in kid.attrs)
            flow.newline() if apart else None
            if tag == "foreignobject":
                self.walk(kid, flow, shown, pre)
            else:
                self.drawing(kid, flow, shown, pre, text or tag in ("text", "math"))
            flow.newline() if apart and tag != "tspan" else None

    def chosen(self, node: Node) -> str:
        options, stack = [], list(reversed(node.kids))
        while stack:
            k = stack.pop()
            if isinstance(k, Node):
                if k.tag == "option":
                    options.append(k)
                else:
                    stack.extend(reversed(k.kids))
        shown = [o for o in options if "selected" in o.attrs][-1:] or options[:1]
        return " ".join(x for o in (options if "multiple" in node.attrs else shown) for x in o.kids if isinstance(x, str))

    def items(self, node: Node, flow: Flow, seen: bool, pre: bool) -> None:
        ordered = node.tag == "ol"
        items = [k for k in node.kids if isinstance(k, Node) and k.tag == "li"]
        step = -1 if "reversed" in node.attrs else 1
        at = _int(node.attrs.get("start"), len(items) if step < 0 else 1)
        for kid in node.kids:
            if isinstance(kid, str):
                if seen:
                    flow.add(kid, pre)
                continue
            if kid.tag != "li":
                self.element(kid, flow, seen, pre)
                continue
            style = self.style(kid)
            if style.get("display") == "none":
                continue
            at = _int(kid.attrs.get("value"), at) if ordered else at
            mark = f"{at}. " if ordered else "- "
            at += step
            shown = style.get("visibility") not in ("hidden", "collapse") if "visibility" in style else seen
            inner = Flow()
            inner.item = True
            self.walk(kid, inner, shown, pre)
            lines = inner.done()
            if lines or shown:
                pad = " " * len(mark)
                flow.block([(mark + (lines[0] if lines else "")).rstrip(" "), *[pad + x if x else x for x in lines[1:]]])

    def table(self, node: Node, seen: bool, pre: bool) -> list[str]:
        out, rows = [], {"thead": [], "tbody": [], "tfoot": []}
        for kid in node.kids:
            if isinstance(kid, str) or kid.tag in NEVER:
                continue
            style = self.style(kid)
            if style.get("display") == "none":
                continue
            shown = style.get("visibility") not in ("hidden", "collapse") if "visibility" in style else seen
            if kid.tag == "caption":
                out.extend(self.lines(kid, shown, pre))
            elif kid.tag in rows:
                for row in kid.kids:
                    if isinstance(row, Node) and row.tag == "tr":
                        rows[kid.tag].append((row, shown))
                    elif isinstance(row, Node):
                        out.extend(self.lines_of(row, shown, pre))
            elif kid.tag not in ("colgroup", "col"):
                out.extend(self.lines_of(kid, shown, pre))
        grid: list[list[tuple[int, int, list[str]]]] = []
        taken: dict[int, int] = {}  # columns that a cell from above still takes, and for how many rows
        for row, shown in [r for part in rows.values() for r in part]:
            style = self.style(row)
            if style.get("display") == "none":
                continue
            shown = style.get("visibility") not in ("hidden", "collapse") if "visibility" in style else shown
            column, cells, below = 0, [], {}
            for cell in row.kids:
                if not isinstance(cell, Node) or cell.tag not in ("td", "th"):
                    if isinstance(cell, Node):
                        out.extend(self.lines_of(cell, shown, pre))
                    continue
                style = self.style(cell)
                if style.get("display") == "none":
                    continue
                while taken.get(column, 0) > 0:
                    column += 1
                span = min(SPAN, max(1, _int(cell.attrs.get("colspan"), 1)))
                down = min(65534, max(1, _int(cell.attrs.get("rowspan"), 1)))
                visible = style.get("visibility") not in ("hidden", "collapse") if "visibility" in style else shown
                cells.append((column, span, self.lines(cell, visible, pre)))
                if down > 1:
                    below.update(dict.fromkeys(range(column, column + span), down))
                column += span
            taken = {c: n - 1 for c, n in taken.items() if n > 1} | {c: n - 1 for c, n in below.items()}
            grid.append(cells)
        widths: dict[int, int] = {}
        for cells in grid:
            for column, span, lines in cells:
                if span == 1:
                    w = max((x for x in map(width, lines) if x <= WIDEST), default=0)
                    widths[column] = max(widths.get(column, 0), w)
        starts, at = {}, 0
        for column in range(max((c + s for cells in grid for c, s, _ in cells), default=0)):
            starts[column] = at
            at += widths[column] + 2 if widths.get(column) else 0
        for cells in grid:
            for k in range(max((len(x) for *_, x in cells), default=0)):
                line, used = [], 0
                for column, _, lines in cells:
                    text = lines[k] if k < len(lines) else ""
                    if text:
                        gap = max(starts[column] - used, 2 if used else 0)
                        line.append(" " * gap + text)
                        used += gap + width(text)
                out.append("".join(line).rstrip(" "))
        return out

    def lines_of(self, node: Node, seen: bool, pre: bool) -> list[str]:
        flow = Flow()
        self.element(node, flow, seen, pre)
        return flow.done()


def _int(text: str | None, other: int) -> int:
    m = re.match(r"\s*([+-]?[0-9]{1,9})", text or "")
    return int(m[1]) if m else other


def render(source: str | None) -> str:
    """The visible text of a page; of a null or empty page the empty text."""
    if not source:
        return ""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 12 * DEPTH))  # a few calls for each depth
    root, css = parse(source)
    return "\n".join(Renderer(sheet(css) if css else {}).lines(root, True, False)).strip("\n")


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The id, text and n_lines of every row of ``pages``.

    The whole page is rendered, however long. A null or empty page has an empty text of 0 lines. Rows don't depend on
    each other: repeated rows and ids, null ids and empty tables need no rule. Other columns are not read.
    """

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [render(x) for x in part.column("html").to_pylist()]
            lines = [x.count("\n") + 1 if x else 0 for x in texts]
            return pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], names=[id_col, "text", "n_lines"])

        return step

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(map_texts(make, "html"), f"{id_col} long, text string, n_lines long")
