"""Visible text of web pages: a small tree builder with implied tags, visibility rules, and a renderer that keeps layout.

Blocks stand on lines of their own, paragraphs and the like are set off by an empty line, list items get their marker and
depth, and table cells are padded to the width of their column. Each page is one row's work; Spark spreads the rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from tarn.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object svg canvas audio video datalist title link meta "
                   "base param source track map area".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog dir div dt figcaption footer form header "
                           "hgroup html legend li main nav optgroup option search section summary tbody td tfoot th thead tr".split())
#: a start tag closes the nearest open one of these, unless one of the limits is nearer
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    **{t: ({"tr", "thead", "tbody", "tfoot", "caption"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, {"html"}),
}
ENDS_PARAGRAPH = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "td", "th", "caption", "option", "optgroup", "legend"}
SCOPE = frozenset({"table", "td", "th", "caption", "html", "button", "template"})
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_CSS_SKIP = re.compile(r"""/\*.*?(?:\*/|\Z)|<!--|-->|"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'""", re.S)
_CSS_PIECE = re.compile(r"([^{};]*)([{};])")
_SELECTOR = re.compile(r"([\w-]*)((?:[.#][\w-]+)*)")
_INNER = re.compile(r"([\w-]*)\(([^()]*)\)")
_RANGE = re.compile(r"(?:([\d.]+\w*)\s*([<>]=?)\s*)?(width|height)(?:\s*([<>]=?|=)\s*([\d.]+\w*))?")
#: fixed values: the screen that at-rules are judged for, and pixels per unit
SCREEN = {"width": 1280.0, "height": 800.0}
UNITS = {"": 1.0, "px": 1.0, "em": 16.0, "rem": 16.0, "pt": 96 / 72, "in": 96.0, "cm": 96 / 2.54, "mm": 96 / 25.4}
TRAITS = frozenset("color grid:0 hover hover:hover any-hover:hover pointer pointer:fine any-pointer:fine orientation:landscape prefers-color-scheme:light "
                   "prefers-reduced-motion:no-preference prefers-contrast:no-preference scripting:enabled scripting update:fast display-mode:browser".split())
_SPACE = re.compile(r"[ \t\n\r\f]+")
MAX_SPAN = 1000


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def parse(page: str) -> Node:
    """The tree of a page: unclosed and misnested tags are closed where HTML implies it, stray end tags are ignored."""
    root = Node("#root", {})
    open_ = [root]
    depth: Counter = Counter()  # open elements by tag, so that nothing is searched in vain

    def close(tags, limits) -> None:
        if not any(depth[t] for t in tags):
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in tags:
                depth.subtract(n.tag for n in open_[i:])
                del open_[i:]
                return
            if open_[i].tag in limits:
                return

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            open_[-1].children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            open_[-1].children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not depth["p"]:
                open_[-1].children.append(Node("p", {}))
            elif tag == "br":
                open_[-1].children.append(Node("br", {}))
            else:
                close({tag}, SCOPE - {tag} if tag not in ("table", "html", "body") else ())
            continue
        if tag in ENDS_PARAGRAPH:
            close({"p"}, SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        elif open_[-1].tag == "head" and tag not in UNSEEN:
            depth[open_.pop().tag] -= 1
        attributes = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t") else {}
        node = Node(tag, attributes)
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*/?>", re.I).search(page, at)
            text = page[at:end.start() if end else len(page)]
            node.children.append(html.unescape(text) if tag in ("textarea", "title") else text)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            open_.append(node)
            depth[tag] += 1
    return root


def _pixels(length: str) -> float:
    m = re.fullmatch(r"([\d.]+)([a-z]*)", length)
    try:
        return float(m[1]) * UNITS[m[2]]
    except (KeyError, TypeError, ValueError):
        return float("nan")


def _feature(text: str) -> bool:
    """Whether one feature of a media query holds on ``SCREEN``; what is not known does not."""
    name, _, value = (x.strip() for x in text.partition(":"))
    if name[:4] in ("min-", "max-") and name[4:] in SCREEN:
        return _pixels(value) <= SCREEN[name[4:]] if name[:3] == "min" else _pixels(value) >= SCREEN[name[4:]]
    if name in SCREEN:
        return not value or _pixels(value) == SCREEN[name]
    m = _RANGE.fullmatch(name)
    if m is None:
        return f"{name}:{value}" in TRAITS if value else name in TRAITS
    holds = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}
    size = SCREEN[m[3]]
    return (m[1] is None or holds[m[2]](_pixels(m[1]), size)) and (m[5] is None or holds[m[4]](size, _pixels(m[5])))


def _condition(words: list[str]) -> bool:
    for joint, how in (("or", any), ("and", all)):
        if joint in words:
            at = words.index(joint)
            return how((_condition(words[:at]), _condition(words[at + 1:])))
    if words[:1] == ["not"]:
        return not _condition(words[1:])
    return [w for w in words if w != "only"] in (["true"], ["all"], ["screen"])


def on_screen(query: str) -> bool:
    """Whether a media query list holds on a wide screen."""
    def inner(m: re.Match) -> str:
        words = m[2].split()
        holds = _condition(words) if words and set(words) <= {"true", "false", "and", "or", "not"} else _feature(m[2].strip())
        return f"{m[1]} {'true' if holds and m[1] in ('', 'and', 'or', 'not') else 'false'} "

    def one(q: str) -> bool:
        n = 1
        while n:
            q, n = _INNER.subn(inner, q)
        words = q.split()
        return not _condition(words[1:]) if words[:1] == ["not"] else _condition(words)

    return not query.strip() or any(one(q) for q in query.lower().split(","))


def _applies(rule: str) -> bool:
    """Whether the rules in the block of an at-rule count on a wide screen."""
    m = re.match(r"@([\w-]+)(.*)", rule, re.S)
    name, rest = (m[1].lower(), m[2]) if m else ("", "")
    if name == "supports":
        return not rest.strip().lower().startswith("not")
    if name == "container":
        return "(" in rest and on_screen(rest[rest.index("("):])
    return on_screen(rest) if name == "media" else name == "layer"


def declarations(text: str) -> dict[str, tuple[bool, bool]]:
    """display and visibility of a list of declarations: (important, hides), the last of equals."""
    out: dict[str, tuple[bool, bool]] = {}
    for part in text.lower().split(";"):
        name, _, value = (x.strip() for x in part.partition(":"))
        if name in ("display", "visibility") and value and "var(" not in value:
            value, important, _ = value.partition("!")
            now = (bool(important), value.strip() in (("none",) if name == "display" else ("hidden", "collapse")))
            if name not in out or important or not out[name][0]:
                out[name] = now
    return out


def style_rules(css: str):
    """(selectors, declarations) of a style sheet in order, without what is in blocks that do not apply to a wide screen."""
    blocks: list[tuple[bool, list[str]]] = [(True, [])]
    for text, end in _CSS_PIECE.findall(_CSS_SKIP.sub(" ", css) + "}"):
        text, (applies, selectors) = text.strip(), blocks[-1]
        if end == "{":
            if text.startswith("@"):
                blocks.append((applies and _applies(text), selectors))
            else:
                # a rule within a rule needs more than one element to match
                blocks.append((applies, [] if selectors else [x.strip() for x in text.split(",")] or [""]))
            continue
        if text and applies and selectors and (found := declarations(text)):
            yield selectors, found
        if end == "}" and len(blocks) > 1:
            blocks.pop()


#: by one part of a selector (tag, .class or #id): all its parts, the property, its rank in the cascade, and whether it hides
Rules = dict[str, list[tuple[frozenset[str], str, tuple, bool]]]


def display_rules(root: Node) -> Rules:
    """Display and visibility rules of the page's style sheets whose selector looks at one element (tag, .class, #id and their joins)."""
    found: Rules = {}
    todo = [root]
    order = 0
    while todo:
        node = todo.pop()
        if node.tag == "style" and node.children and on_screen(node.attributes.get("media", "")):
            for selectors, declared in style_rules(node.children[0]):
                order += 1
                for m in filter(None, map(_SELECTOR.fullmatch, selectors)):
                    marks = re.findall(r"[.#][\w-]+", m[2])
                    parts = [*marks, *([m[1].lower()] if m[1] else [])]
                    ids = sum(x[0] == "#" for x in marks)
                    for name, (important, hides) in declared.items() if parts else ():
                        found.setdefault(parts[0], []).append((frozenset(parts), name, (important, False, ids, len(marks) - ids, bool(m[1]), order), hides))
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found if any(hides for rules in found.values() for *_, hides in rules) else {}


def hidden(node: Node, rules: Rules) -> bool:
    a = node.attributes
    if node.tag in UNSEEN or "hidden" in a:
        return True
    if node.tag == "dialog" and "open" not in a or node.tag == "input" and a.get("type", "").lower() == "hidden":
        return True
    best: dict[str, tuple[tuple, bool]] = {}
    if rules and node.tag != "#root":
        own = {node.tag, *["." + c for c in a.get("class", "").split()], *(["#" + a["id"]] if "id" in a else [])}
        for part in own & rules.keys():
            for parts, name, rank, hides in rules[part]:
                if parts <= own and (name not in best or rank > best[name][0]):
                    best[name] = (rank, hides)
    if "style" in a:
        for name, (important, hides) in declarations(a["style"]).items():
            if name not in best or (important, True) > best[name][0]:
                best[name] = ((important, True), hides)
    return any(hides for _, hides in best.values())


class Lines:
    """Text of one flow: lines, with pending breaks and collapsed white space."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # empty lines wanted before the next text
        self.space = False
        self.prefix = ""  # marker for the next line
        self.indent: list[str] = []

    def text(self, s: str, verbatim: bool = False) -> None:
        if verbatim:
            parts = s.replace("\r\n", "\n").split("\n")
            for i, part in enumerate(parts):
                if i:
                    self.end_line(keep=True)
                self.put(part)
            return
        for i, word in enumerate(_SPACE.split(s)):
            if i:
                self.space = True
            if word:
                if self.space and self.line:
                    self.line.append(" ")
                self.put(word)

    def put(self, s: str) -> None:
        if not s:
            return
        s = s.replace("\xa0", " ").replace("\xad", "").replace("​", "")
        if not self.line:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line = [*self.indent, self.prefix]
            self.prefix = ""
        self.line.append(s)
        self.space = False

    def end_line(self, keep: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        elif keep:
            self.lines += [""] * bool(self.lines)
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.lines:
            self.gap = 1

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _span(node: Node, name: str) -> int:
    value = node.attributes.get(name, "1").strip()
    return min(MAX_SPAN, max(1, int(value))) if re.fullmatch(r"[0-9]{1,6}", value) else 1


class Grid:
    """Cells of one table; ``lay_out`` pads each to the width of its column."""

    def __init__(self) -> None:
        self.rows: list[dict[int, list[str]]] = []
        self.taken: dict[int, int] = {}  # column -> rows below that a cell of an earlier row still covers
        self.column = 0

    def next_row(self) -> None:
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append({})
        self.column = 0

    def cell(self, node: Node, lines: list[str]) -> None:
        if not self.rows:
            self.next_row()
        while self.taken.get(self.column, 0) and self.column not in self.rows[-1]:
            self.column += 1
        self.rows[-1][self.column] = lines
        wide, high = _span(node, "colspan"), _span(node, "rowspan")
        if high > 1:
            self.taken |= {c: high for c in range(self.column, self.column + wide)}
        self.column += wide

    def lay_out(self) -> list[str]:
        used = sorted({c for row in self.rows for c in row})
        width = {c: max((len(x) for row in self.rows for x in row.get(c, [])), default=0) for c in used}
        used = [c for c in used if width[c]]
        out = []
        for row in self.rows:
            for i in range(max((len(x) for x in row.values()), default=0)):
                cells = [(row.get(c, [])[i:i + 1] or [""])[0].ljust(width[c]) for c in used]
                while cells and not cells[-1].strip():
                    cells.pop()
                out.append(" | ".join(cells).rstrip())
        return [x for x in out if x]


def render(root: Node) -> str:
    rules = display_rules(root)
    flows, grids, lists = [Lines()], [], []
    depth_pre = 0
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            flow.text(node, depth_pre > 0)
            continue
        tag = node.tag
        if not leaving:
            if hidden(node, rules):
                continue
            if tag == "br":
                flow.end_line(keep=not flow.line)
                continue
            if tag == "input" and node.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                flow.text(node.attributes.get("value", ""))
                continue
            if tag in ("td", "th") and grids:
                flows.append(Lines())
            elif tag in BLOCK:
                flow.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "table":
                grids.append(Grid())
            elif tag == "tr" and grids:
                grids[-1].next_row()
            elif tag in ("ul", "ol", "menu", "dir"):
                start = node.attributes.get("start", "1")
                lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif tag == "li":
                if lists and lists[-1][0] == "ol":
                    value = node.attributes.get("value", "")
                    number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else lists[-1][1]
                    lists[-1][1] = number + 1
                    flow.prefix = f"{number}. "
                else:
                    flow.prefix = "- "
                flow.indent.append("  " * (len(lists) > 1))
            elif tag in ("blockquote", "dd"):
                flow.indent.append("  ")
            elif tag == "pre":
                depth_pre += 1
            elif tag == "hr":
                continue
            todo.append((node, True))
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            todo.extend((c, False) for c in reversed(children))
            continue
        if tag in ("td", "th") and grids:
            lines = flows.pop().done()
            grids[-1].cell(node, lines)
            continue
        if tag == "table" and grids:
            lines = grids.pop().lay_out()
            for line in lines:
                flow.put(line)
                flow.end_line()
        if tag in ("ul", "ol", "menu", "dir") and lists:
            lists.pop()
        if tag in ("li", "blockquote", "dd"):
            flow.end_line()
            flow.prefix = ""
            flow.indent.pop()
        if tag == "pre":
            depth_pre -= 1
        if tag in BLOCK:
            flow.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
    return "\n".join(flows[0].done())


def page_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def visible_text(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """(key, text), one row for each row of ``pages``; a null or empty page has an empty text, repeated rows are each rendered,
    other columns are ignored."""
    def run(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([page_text(p) for p in batch.column(column).to_pylist()], pa.string())],
                                         names=[key, "text"])

    return map_batches(pages.select(key, column), run, f"`{key}` {dict(pages.dtypes)[key]}, text string")
