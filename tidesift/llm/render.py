"""Layout-aware rendering of HTML: all visible text, with blocks, lists and tables as a reader sees them.

A tree builder reads tags one by one, adds the end tags that HTML implies, and closes what is left open. An element
is laid out when it ends, so nesting is bounded by memory alone: inline elements write into the block around them, and
blocks hand finished lines to their parent.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from tidesift.llm.textbytes import with_columns

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?)*+)>|<[!?/][^>]*>""", re.S
)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Widest column that other rows are padded to; longer cells stand out.
WIDEST = 60

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
UNSEEN = set("head script style title noscript template iframe noembed noframes object audio video canvas datalist".split())
#: What svg and math hold and do not show, and elements of theirs that stand apart.
FOREIGN = {
    "svg": set("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": set("annotation annotation-xml mphantom".split()),
}
APART = {"svg": {"text"}, "math": {"mtd"}}
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl menu blockquote pre table figure fieldset".split())
BLOCKS = SPACED | set(
    "html body div section article aside header footer nav main address center form details summary dialog dir hgroup legend "
    "figcaption li dt dd hr tr td th thead tbody tfoot caption optgroup option select search textarea xmp".split()
)
#: What a start tag ends, and the elements that this does not reach across.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}), "dt": ({"dt", "dd"}, {"dl", "table"}), "dd": ({"dt", "dd"}, {"dl", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}), **dict.fromkeys(["select", "input", "textarea"], ({"select"}, {"table"})),
    **dict.fromkeys(["thead", "tbody", "tfoot"], ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"})),
}
P_ENDS = BLOCKS - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "select", "html", "body", "legend"}
#: A start tag does not end a paragraph outside these.
P_WALLS = {"td", "th", "table", "caption", "button", "object", "body"}


class Block:
    """An open block: text and finished blocks in order."""

    __slots__ = ("tag", "attrs", "parts", "rows", "unseen", "pre", "count", "shown", "options")

    def __init__(self, tag: str, attrs: dict, unseen: bool, pre: bool, shown: bool = True):
        self.tag, self.attrs, self.unseen, self.pre, self.shown = tag, attrs, unseen, pre, shown
        self.parts: list = []  # text, or (lines, blank lines around it)
        self.rows: list = []  # of a table: rows of (lines, columns)
        self.count = 0  # of list items
        self.options: list = []  # of a select: (attributes or None for a group's label, lines)


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in ATTR.findall(source):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


def _hidden(tag: str, attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or tag in UNSEEN or (tag == "dialog" and "open" not in attrs):
        return True
    style = re.sub(r"\s", "", attrs.get("style", "").lower())
    return "display:none" in style or (tag in ("tr", "thead", "tbody", "tfoot") and _visibility(attrs) == "collapse")


def _visibility(attrs: dict[str, str]) -> str:
    """What an element states for itself and for what is in it, or nothing."""
    if "style" not in attrs:
        return ""
    found = re.findall(r"(?:^|;)visibility:([a-z]+)", re.sub(r"\s", "", attrs.get("style", "").lower()))
    return found[-1] if found else ""


def _chosen(options: list, attrs: dict[str, str]) -> list[str]:
    """What a select shows: all options of a list box, else the last that is selected or the first that can be."""
    if "multiple" in attrs or _number(attrs.get("size"), 0, 1000, 1) > 1:
        return [x for _, lines in options for x in lines]
    real = [(own, lines) for own, lines in options if own is not None]
    selected = [lines for own, lines in real if "selected" in own]
    free = [lines for own, lines in real if "disabled" not in own]
    return selected[-1] if selected else free[0] if free else []


def _number(text: str | None, low: int, high: int, default: int) -> int:
    return min(max(int(text), low), high) if text and re.fullmatch(r"-?[0-9]{1,9}", text) else default


def _lines(block: Block) -> list[str]:
    """The lines of a block: white space collapses but in preformatted text, ``\\v`` marks forced breaks."""
    out: list[str] = []
    gap = 0
    run: list[str] = []

    def flush() -> None:
        nonlocal gap
        text = "".join(run)
        run.clear()
        if block.pre:
            own = text.replace("\v", "\n").split("\n")
            own = own[1:] if own and not own[0] else own
            while own and not own[-1].strip():
                own.pop()
        else:
            own = [SPACE.sub(" ", x).strip(" ") for x in text.split("\v")]
            while own and not own[-1]:
                own.pop()
        if own and any(x.strip() for x in own):
            out.extend([""] * (gap if out else 0) + own)
            gap = 0

    for part in block.parts:
        if isinstance(part, str):
            run.append(part)
            continue
        flush()
        lines, space = part
        if lines:
            out.extend([""] * (max(gap, space) if out else 0))
            out.extend(lines)
            gap = space
    flush()
    return out


def _table(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Cells side by side in columns of one width."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(WIDEST, max(map(len, lines), default=0)))
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            at, line = 0, []
            for lines, span in row:
                room = sum(widths.get(i, 0) for i in range(at, at + span)) + 2 * (span - 1)
                line.append((lines[k] if k < len(lines) else "").ljust(min(room, WIDEST * span)))
                at += span
            out.append("  ".join(line).rstrip())
    return out


class Builder:
    def __init__(self):
        self.root = Block("#root", {}, False, False)
        self.blocks = [self.root]
        self.open: list[str] = []  # all open elements, inline ones too
        self.hidden: list[bool] = [False]  # whether what is in each open element is unseen
        self.shown: list[bool] = [True]  # and whether it is visible, which an element in it can undo
        self.places: dict[str, list[int]] = {}  # of each open kind

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        foreign = self.foreign()
        unseen = self.hidden[-1] or _hidden(tag, attrs) or (foreign and (tag in FOREIGN[foreign] or attrs.get("display") == "none"))
        states = _visibility(attrs) or (foreign and attrs.get("visibility"))
        shown = states == "visible" if states in ("visible", "hidden", "collapse") else self.shown[-1]
        parent = self.blocks[-1]
        if parent.tag == "details" and "open" not in parent.attrs and tag != "summary":
            unseen = True
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(tag)
        self.hidden.append(bool(unseen))
        self.shown.append(shown)
        if tag in BLOCKS:
            self.blocks.append(Block(tag, attrs, bool(unseen), parent.pre or tag in ("pre", "xmp", "textarea"), shown))

    def foreign(self) -> str:
        """Which of svg and math is the innermost that is open, if any; foreign objects hold HTML again."""
        if not (self.places.get("svg") or self.places.get("math")):
            return ""
        last = {x: self.places[x][-1] for x in ("svg", "math", "foreignobject") if self.places.get(x)}
        tag = max(last, key=last.get, default="")
        return tag if tag in FOREIGN else ""

    def text(self, source: str) -> None:
        if self.open and self.open[-1] == "head" and source.strip(" \t\n\r\f"):
            self.end("head")
        if self.hidden[-1] or not self.shown[-1]:
            return
        block = self.blocks[-1]
        if block.tag == "details" and "open" not in block.attrs:
            return
        if block.tag in ("table", "tr", "thead", "tbody", "tfoot") and not source.strip():
            return
        block.parts.append(unescape(source).replace("\v", " "))

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body") and self.places.get(tag):
            return
        if tag not in ("html", "head", "title", "meta", "link", "base", "script", "style", "template", "noscript") and self.places.get("head"):
            self.end("head")
        if tag in P_ENDS and self.places.get("p"):
            walls = max((self.places[w][-1] for w in P_WALLS if self.places.get(w)), default=-1)
            if self.places["p"][-1] > walls:
                self.close(self.places["p"][-1])
        if tag in ENDS:
            kinds, walls = ENDS[tag]
            wall = max((self.places[w][-1] for w in walls if self.places.get(w)), default=-1)
            first = min((i for k in kinds for i in self.places.get(k, ()) if i > wall), default=None)
            if first is not None:
                self.close(first)
        if tag in ("td", "th", "tr") and self.places.get("table"):
            inside = lambda *names: any(self.places.get(x) and self.places[x][-1] > self.places["table"][-1] for x in names)
            if not inside("thead", "tbody", "tfoot"):
                self.push("tbody", {})
            if tag != "tr" and not inside("tr"):
                self.push("tr", {})
        if tag == "br":
            if not self.hidden[-1]:
                self.blocks[-1].parts.append("\v")
        elif tag == "hr":
            self.blocks[-1].parts.append(([], 0))
        elif tag == "input" and not self.hidden[-1] and self.shown[-1] and not _hidden(tag, attrs) and _visibility(attrs) in ("", "visible"):
            if attrs.get("type", "").lower() in ("submit", "button", "reset"):
                self.blocks[-1].parts.append(f" {attrs.get('value', '')} ")
        elif tag not in VOID:
            self.push(tag, attrs)

    def end(self, tag: str) -> None:
        if tag == "p" and not self.places.get("p"):
            self.blocks[-1].parts.append(([], 1))  # an end alone is an empty paragraph
        elif tag == "br":
            self.start("br", {})
        elif self.places.get(tag):
            at = self.places[tag][-1]
            wall = max((self.places[w][-1] for w in ("td", "th", "table", "caption") if self.places.get(w)), default=-1)
            if at >= wall or tag in ("table", "tr", "thead", "tbody", "tfoot", "body", "html"):
                self.close(at)

    def close(self, down_to: int) -> None:
        while len(self.open) > down_to:
            tag = self.open.pop()
            self.places[tag].pop()
            foreign = self.foreign()
            if foreign and tag in APART[foreign] and not self.hidden[-1]:
                self.blocks[-1].parts.append(" ")
            self.hidden.pop()
            self.shown.pop()
            if tag in BLOCKS:
                self.finish(self.blocks.pop())

    def finish(self, block: Block) -> None:
        parent = self.blocks[-1]
        if block.unseen:
            parent.parts.append(([], 0)) if not parent.unseen else None
            return
        tag = block.tag
        if tag in ("option", "optgroup", "select") and self.select(block, parent):
            return
        if tag in ("td", "th") and parent.tag == "tr":
            parent.rows.append((_lines(block), _number(block.attrs.get("colspan"), 1, 1000, 1)))
            return
        own = _lines(block)
        if tag == "tr" and parent.tag in ("table", "thead", "tbody", "tfoot"):
            parent.rows.append(block.rows + ([(own, 1)] if own else []))
            return
        if tag in ("thead", "tbody", "tfoot") and parent.tag == "table":
            parent.rows.extend(block.rows)
            parent.parts.append((own, 0))
            return
        if block.rows:
            rows = [block.rows] if tag == "tr" else block.rows
            own = own + _table(rows)
        if tag == "li":
            parent.count += 1
            first = _number(parent.attrs.get("start"), -(10**9), 10**9, 1)
            mark = f"{_number(block.attrs.get('value'), -(10**9), 10**9, first + parent.count - 1)}. " if parent.tag == "ol" else "- "
            mark = mark if block.shown else ""
            own = [mark + own[0], *((" " * len(mark) + x if x else x) for x in own[1:])] if own else []
        elif tag in ("dd", "blockquote"):
            own = [f"  {x}" if x else x for x in own]
        nested = tag in ("ul", "ol", "menu") and any(self.places.get(x) for x in ("ul", "ol", "menu"))
        parent.parts.append((own, 1 if tag in SPACED and not nested else 0))


    def select(self, block: Block, parent: Block) -> bool:
        """Hands options to the select around them, and what a select shows to its parent."""
        if block.tag != "select" and parent.tag not in ("select", "optgroup"):
            return False
        label = block.attrs.get("label", "").strip()
        if block.tag == "option":
            parent.options.append((block.attrs, [label] if label and block.shown else _lines(block)))
        elif block.tag == "optgroup":
            off = {"disabled": ""} if "disabled" in block.attrs else {}
            parent.options += [(None, [label])] * bool(label and block.shown)
            parent.options += [(own if own is None else own | off, lines) for own, lines in block.options]
        else:
            own = _chosen(block.options, block.attrs)
            parent.parts.append((own, 0) if len(own) > 1 else f" {own[0]} " if own else " ")
        return True


def render(html: str) -> str:
    """The visible text of a page. Markup that is cut off at the end counts as text."""
    builder = Builder()
    at = 0
    size = len(html)
    last = html.rfind(">") + 1  # no markup ends behind it
    while at < size:
        found = TOKEN.search(html, at, last) if at < last else None
        if not found:
            builder.text(html[at:])
            break
        if found.start() > at:
            builder.text(html[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if found["end"]:
            builder.end(tag)
            continue
        if tag not in VOID and found["attrs"].endswith("/") and builder.foreign():
            continue  # empty
        builder.start(tag, _attributes(found["attrs"]) if found["attrs"].strip(" /") else {})
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            cut = stop.start() if stop else size
            builder.text(html[at:cut])
            at = cut
            if not stop:
                break
    builder.close(0)
    return "\n".join(_lines(builder.root))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """The rows with the visible text of their whole page; empty for null and empty pages, and for pages without any.

    Blocks stand on lines of their own, with a blank line around paragraphs, headings, lists and tables; list items
    have marks, and cells of a table columns of one width. Repeated rows get equal texts. A column named like the
    new one is replaced, the others pass through.
    """

    def compute(piece: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([render(h) if h else "" for h in piece.column(html).to_pylist()], pa.string())]

    return with_columns(pages, html, [StructField(out, StringType())], compute)
