"""Text of HTML pages by layout: a tree builder with implied tags, visibility rules and a renderer.

The builder closes what a start tag ends (paragraphs before blocks, items before items, cells before
cells, rows before rows), knows empty and raw-text elements, ignores end tags without a start and
drops comments. What a browser does not show is left out: the head, scripts, templates and fallback
content, closed details and dialogs, elements hidden by attribute, by their own style or by a rule for a
tag, class or id in a style sheet of the page. Blocks of a sheet count if their condition holds on a screen of
``WIDTH`` by ``HEIGHT`` pixels. Everything else is emitted: blocks on lines of their own,
with a blank line around paragraphs, headings, lists and tables; list items with bullets or numbers and
indents; preformatted text as it stands; table cells padded to the width of their column.

Pages are independent, so tasks render them in Arrow batches; a page is a row and never shared out.

Edge cases: null and empty pages have an empty text; text without any tag is one block; a tag that is cut off at
the end of the page is dropped; elements nested deeper than ``DEPTH`` become siblings. Rows that
repeat an id are rendered one by one. An empty table gives an empty result; columns other than ``page_id`` and
``html`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import table

DEPTH = 150
#: The screen that conditions of style sheets are held against.
WIDTH, HEIGHT = 1280, 800
#: Nested blocks and brackets of a style sheet that are looked into.
CSS_DEPTH = 20

# Classes of elements as the HTML standard has them.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title plaintext".split())
NEVER_SHOWN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas datalist map rp title meta link base".split()
)
BLOCKS = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li legend listing main menu nav ol optgroup option p pre search section summary ul xmp "
    "table caption thead tbody tfoot tr td th".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu pre listing xmp blockquote figure table hr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr li dd dt listing main menu nav ol p pre search section summary table ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag ends the nearest open element of its set, unless one of the others stands in between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "table", "td", "th"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "body": (frozenset(["head"]), frozenset()),
}
#: Start tags that may stand in the head; any other one ends it.
HEAD_TAGS = frozenset("base link meta noscript script style template title head html".split())

#: A quote opens a string only at the start of a value; elsewhere it is a plain character.
_VALUE = r"""[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"([^"]*+)"|'([^']*+)'|([^ \t\n\r\f"'>][^ \t\n\r\f>]*+)|(?=>|\Z))"""
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_TAG = re.compile(
    rf"<(/?)([a-zA-Z][^ \t\n\r\f/>]*+)((?:[ \t\n\r\f/]++|{_NAME}(?:{_VALUE}|(?![ \t\n\r\f]*+=)))*+)>"
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:{_VALUE})?")
#: A comment also ends right after its start, and with a bang.
_COMMENT_END = re.compile(r"(?:(?<=<!--)-?|--!?)>")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_CSS_MARK = re.compile(r""""(?:\\.|[^"\\\n])*+"?|'(?:\\.|[^'\\\n])*+'?|\\.|\([^(){}"']*+\)|[{};]""", re.S)
_CONDITION = re.compile(r"""\s*+("[^"]*+"?|'[^']*+'?|[()]|[<>]=?|[=:,/]|[^\s()<>=:,/"']++)""")
_LENGTH = re.compile(r"([+-]?(?:\d+\.?\d*|\.\d+))(px|r?em|pt|pc|in|cm|mm|q|dppx|x|dpi|dpcm)?$")
_PIXELS = {"px": 1, "em": 16, "rem": 16, "pt": 96 / 72, "pc": 16, "in": 96, "cm": 96 / 2.54, "mm": 96 / 25.4, "q": 96 / 101.6}
_DOTS = {"dppx": 1, "x": 1, "dpi": 1 / 96, "dpcm": 2.54 / 96}
_NUMBERS = {
    "width": WIDTH, "height": HEIGHT, "device-width": WIDTH, "device-height": HEIGHT, "inline-size": WIDTH, "block-size": HEIGHT,
    "aspect-ratio": WIDTH / HEIGHT, "device-aspect-ratio": WIDTH / HEIGHT, "resolution": 1, "-webkit-device-pixel-ratio": 1,
    "color": 8, "color-index": 0, "monochrome": 0, "grid": 0,
}
_WORDS = {
    "orientation": "landscape", "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "update": "fast",
    "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference",
    "prefers-reduced-data": "no-preference", "prefers-reduced-transparency": "no-preference", "forced-colors": "none",
    "inverted-colors": "none", "display-mode": "browser", "scripting": "enabled", "overflow-block": "scroll",
    "overflow-inline": "scroll", "dynamic-range": "standard", "color-gamut": "srgb",
}
_COMPARE = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}
_IMPORTANT = re.compile(r"!\s*important\s*$")
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_SELECTOR = re.compile(r"(?:[a-zA-Z][\w-]*|[.#][\w-]+)$")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Element | str] = []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if source.strip(" \t\n\r\f/"):
        for name, double, single, bare in _ATTRIBUTE.findall(source):
            found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) with kinds text, raw, start and end."""
    at, size = 0, len(html)
    while at < size:
        open_ = html.find("<", at)
        if open_ < 0:
            yield "text", html[at:], ""
            return
        if open_ > at:
            yield "text", html[at:open_], ""
        follows = html[open_ + 1 : open_ + 3]
        if html.startswith("<!--", open_):
            end = _COMMENT_END.match(html, open_ + 4) or _COMMENT_END.search(html, open_ + 4)
            at = size if end is None else end.end()
        elif follows[:1] in ("!", "?") or follows[:1] == "/" and not follows[1:].isalpha():
            end = html.find(">", open_)
            at = size if end < 0 else end + 1
        elif not (follows[:1] == "/" or follows[:1].isascii() and follows[:1].isalpha()):
            yield "text", "<", ""
            at = open_ + 1
        else:
            match = _TAG.match(html, open_)
            if match is None:
                return  # cut off inside the tag
            name, at = match[2].lower(), match.end()
            yield ("end" if match[1] else "start"), name, match[3]
            if name in RAW and not match[1]:
                close = None if name == "plaintext" else re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                end = size if close is None else close.start()
                yield "raw", html[at:end], name
                at = end


def parse(html: str) -> tuple[Element, list[str]]:
    """The tree of a page and the texts of its style sheets."""
    root = Element("html", {})
    stack, sheets = [root], []

    def close(names: frozenset[str], stops: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    for kind, name, rest in tokens(html):
        if kind == "text":
            if stack[-1].tag == "head" and name.strip(" \t\n\r\f"):
                stack.pop()
            stack[-1].children.append(unescape(name) if "&" in name else name)
        elif kind == "raw":
            if rest == "style":
                media = stack[-1].attributes.get("media", "") if stack[-1].tag == rest else ""
                if on_screen(media):
                    sheets.append(name)
            if stack[-1].tag == rest:
                stack[-1].children.append(unescape(name) if rest in ("textarea", "title") else name)
        elif kind == "start":
            if name in ("html", "frameset"):
                continue
            if name == "body":
                close(frozenset(["head"]))
                continue
            if stack[-1].tag == "head" and name not in HEAD_TAGS:
                stack.pop()
            if name in CLOSES_P:
                close(frozenset(["p"]), frozenset(["table", "td", "th", "caption", "button", "object", "template"]))
            if name in HEADINGS and stack[-1].tag in HEADINGS:
                stack.pop()
            if name in ENDS:
                close(*ENDS[name])
            if name in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                row = Element("tr", {})
                stack[-1].children.append(row)
                stack.append(row)
            element = Element(name, _attributes(rest) if rest else {})
            stack[-1].children.append(element)
            if name not in EMPTY and len(stack) < DEPTH:
                stack.append(element)
        elif name == "br":
            stack[-1].children.append(Element("br", {}))
        elif name == "p" and not any(e.tag == "p" for e in stack):
            stack[-1].children.append(Element("p", {}))
        elif name not in ("html", "body"):
            scope = frozenset() if name in ("table", "td", "th", "tr") else frozenset(["td", "th", "table"])
            close(HEADINGS if name in HEADINGS else frozenset([name]), scope - {name})
    return root, sheets


def _declared(style: str) -> dict[str, tuple[bool, str]]:
    """The declarations of a style: whether they are important, and the value; the last of equal rank counts."""
    found: dict[str, tuple[bool, str]] = {}
    for name, _, value in (d.partition(":") for d in style.lower().split(";")):
        plain = _IMPORTANT.sub("", value)
        _override(found, {name.strip(): (plain != value, plain.strip())})
    return found


def _override(found: dict[str, tuple[bool, str]], later: dict[str, tuple[bool, str]]) -> None:
    """Later declarations win, except plain ones against important ones."""
    for name, (important, value) in later.items():
        if important or name not in found or not found[name][0]:
            found[name] = important, value


def _number(source: list[str]) -> float | None:
    if len(source) == 3 and source[1] == "/":
        above, below = _number(source[:1]), _number(source[2:])
        return above / below if above is not None and below else None
    match = _LENGTH.match(source[0]) if len(source) == 1 else None
    return float(match[1]) * {**_PIXELS, **_DOTS}.get(match[2], 1) if match else None


def _feature(parts: list[str]) -> bool | None:
    """Whether a media feature holds; None if it is not known."""
    name = parts[0] if parts else ""
    if len(parts) == 1:
        return bool(_NUMBERS[name]) if name in _NUMBERS else _WORDS[name] not in ("none", "no-preference") if name in _WORDS else None
    if parts[1:2] == [":"]:
        if name in _WORDS:
            return parts[2:] == [_WORDS[name]]
        sign = "<=" if "min-" in name else ">=" if "max-" in name else "="
        parts = [*parts[2:], sign, re.sub("^(-webkit-)?(min|max)-", r"\1", name)]
    # A range: numbers around the name, with signs between them.
    sides: list[list[str]] = [[]]
    signs = []
    for part in parts:
        if part in _COMPARE:
            signs.append(part)
            sides.append([])
        else:
            sides[-1].append(part)
    values = [float(_NUMBERS[x[0]]) if len(x) == 1 and x[0] in _NUMBERS else _number(x) for x in sides]
    if not signs or None in values:
        return None
    return all(_COMPARE[sign](values[i], values[i + 1]) for i, sign in enumerate(signs))


def _holds(parts: list[str], feature: Callable[[list[str]], bool | None], depth: int = 0) -> bool | None:
    """The value of a condition of brackets, media types, ``not``, ``and`` and ``or``; None if it is not known."""
    values: list[bool | None] = []
    join, negated, at = "", False, 0
    while at < len(parts):
        part = parts[at]
        at += 1
        if part in ("and", "or"):
            join = part
            continue
        if part == "not":
            negated = not negated
            continue
        if part == "only":
            continue
        call = part != "(" and parts[at : at + 1] == ["("]
        if part == "(" or call:
            start, open_ = at + call, 1
            at = start
            while at < len(parts) and open_:
                open_ += (parts[at] == "(") - (parts[at] == ")")
                at += 1
            inner = parts[start : at - (not open_)]
            if call:
                value = feature([part, "(", *inner])
            elif inner[:1] in (["("], ["not"]):
                value = _holds(inner, feature, depth + 1) if depth < CSS_DEPTH else None
            else:
                value = feature(inner)
        else:
            value = part in ("all", "screen")
        # The 'not' before a media type is for all that follows.
        if negated and part != "(" and not call:
            rest = _holds([part, *parts[at:]], feature, depth + 1) if depth < CSS_DEPTH else None
            return None if rest is None else not rest
        values.append(None if value is None else value != negated)
        negated = False
    if not values:
        return True
    ends = join == "or"
    return ends if ends in values else None if None in values else not ends


def _parts(condition: str) -> list[str]:
    return _CONDITION.findall(condition.lower())


def on_screen(media: str) -> bool:
    """Whether a list of media queries holds on a screen of ordinary size."""
    queries: list[list[str]] = [[]]
    open_ = 0
    for part in _parts(media):
        open_ += (part == "(") - (part == ")")
        if part == "," and not open_:
            queries.append([])
        else:
            queries[-1].append(part)
    return any(_holds(query, _feature) is True for query in queries)


def _applies(rule: str) -> bool:
    """Whether the rules inside an at-rule count."""
    name, _, condition = rule[1:].replace("(", " (", 1).partition(" ")
    name = name.strip().lower()
    if name == "media":
        return on_screen(condition)
    if name == "supports":
        return _holds(_parts(condition), lambda parts: True) is True
    if name == "container":  # as wide as the screen; its name comes first
        parts = _parts(condition)
        named = parts and parts[0] not in ("(", "not") and parts[1:2] != ["("] or parts[1:2] == ["("] and parts[0] not in ("not", "style", "(")
        return _holds(parts[1:] if named else parts, _feature) is True
    return name == "layer"


def _blocks(sheet: str) -> Iterator[tuple[str, str | None]]:
    """The rules at the top of a sheet with their bodies, and the statements without one."""
    depth, start, body = 0, 0, 0
    for mark in _CSS_MARK.finditer(sheet):
        if mark[0] == "{":
            depth += 1
            if depth == 1:
                body = mark.end()
        elif mark[0] == "}" and depth:
            depth -= 1
            if not depth:
                yield sheet[start : body - 1].strip(), sheet[body : mark.start()]
                start = mark.end()
        elif mark[0] == ";" and not depth:
            yield sheet[start : mark.start()].strip(), None
            start = mark.end()
    if depth:
        yield sheet[start : body - 1].strip(), sheet[body:]
    elif sheet[start:].strip():
        yield sheet[start:].strip(), None


def _rules(sheet: str, depth: int = 0) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules that count on a screen."""
    for rule, body in _blocks(sheet):
        if body is None:
            continue
        if not rule.startswith("@"):
            yield rule, _own(body)
        elif depth < CSS_DEPTH and _applies(" ".join(rule.split())):
            yield from _rules(body, depth + 1)


def _own(body: str, depth: int = 0) -> str:
    """The declarations of a rule without those of the rules nested in it."""
    if "{" not in body:
        return body
    found = []
    for rule, inner in _blocks(body):
        if inner is None:
            found.append(rule)
        elif rule.startswith("@") and depth < CSS_DEPTH and _applies(" ".join(rule.split())):
            found.append(_own(inner, depth + 1))
    return ";".join(found)


class Visibility:
    """Which elements are shown: by tag, attributes, own style and simple rules of style sheets."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, dict[str, tuple[bool, str]]] = {}
        for sheet in sheets:
            for selectors, body in _rules(_CSS_COMMENT.sub("", sheet)):
                declared = {k: v for k, v in _declared(body).items() if k in ("display", "visibility")}
                if declared:
                    for selector in map(str.strip, selectors.split(",")):
                        if _SELECTOR.match(selector):
                            _override(self.rules.setdefault(selector if selector[0] in ".#" else selector.lower(), {}), declared)

    def of(self, element: Element, visible: bool) -> tuple[bool, bool]:
        """Whether the element has a box, and whether its own text is visible."""
        tag, attributes = element.tag, element.attributes
        if tag in NEVER_SHOWN:
            return False, False
        if not attributes and not self.rules:
            return tag != "dialog", visible
        declared = dict(self.rules.get(tag, ())) if self.rules else {}
        if attributes:
            for name in attributes.get("class", "").split() if self.rules else ():
                _override(declared, self.rules.get("." + name, {}))
            if "id" in attributes and self.rules:
                _override(declared, self.rules.get("#" + attributes["id"], {}))
            if "style" in attributes:
                _override(declared, _declared(attributes["style"]))
        display = declared["display"][1] if "display" in declared else None
        if display == "none" or display is None and ("hidden" in attributes or tag == "dialog" and "open" not in attributes):
            return False, False
        if tag == "input" and attributes.get("type", "").lower() == "hidden":
            return False, False
        state = declared["visibility"][1] if "visibility" in declared else None
        return True, visible if state in (None, "inherit") else state not in ("hidden", "collapse")


class Flow:
    """Lines of text: collapses spaces, keeps the largest of adjoining breaks, indents lists."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent = ""
        self.marker = ""
        self.breaks = 0
        self.space = False

    def _begin(self) -> None:
        if self.breaks and self.lines:
            self.lines.extend([""] * (self.breaks - 1))
        self.breaks = 0
        if not self.line:
            if self.marker:
                self.line.append(self.indent[: len(self.indent) - len(self.marker)] + self.marker)
                self.marker = ""
            else:
                self.line.append(self.indent)

    def text(self, data: str) -> None:
        parts = _SPACE.sub(" ", data)
        if not parts:
            return
        empty = not self.line
        body = parts.strip(" ")
        if body:
            lead = (self.space or parts[0] == " ") and not empty
            self._begin()
            self.line.append((" " if lead else "") + body)
            self.space = parts[-1] == " "
        elif not empty:
            self.space = True

    def verbatim(self, data: str) -> None:
        for i, part in enumerate(data.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if i:
                self.end_line(force=True)
            if part:
                lead = " " if self.space and self.line else ""
                self._begin()
                self.line.append(lead + part)
                self.space = False

    def end_line(self, force: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif force:
            if self.breaks and self.lines:
                self.lines.extend([""] * (self.breaks - 1))
                self.breaks = 0
            self.lines.append("")
        self.space = False

    def block(self, breaks: int) -> None:
        self.end_line()
        self.breaks = max(self.breaks, breaks)

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            self._begin()
            self.line.append(line)
            self.end_line()

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


class Renderer:
    def __init__(self, visibility: Visibility):
        self.visibility = visibility

    def children(self, element: Element, flow: Flow, visible: bool, verbatim: bool) -> None:
        for child in element.children:
            if isinstance(child, str):
                if visible:
                    (flow.verbatim if verbatim else flow.text)(child)
            else:
                self.element(child, flow, visible, verbatim)

    def element(self, element: Element, flow: Flow, visible: bool, verbatim: bool) -> None:
        shown, visible = self.visibility.of(element, visible)
        if not shown:
            return
        tag = element.tag
        if tag == "br":
            flow.end_line(force=True)
        elif tag == "wbr" or tag in EMPTY and tag != "hr":
            if tag == "input" and visible and element.attributes.get("type", "text").lower() in ("submit", "button", "reset"):
                flow.text(" " + element.attributes.get("value", "") + " ")
        elif tag == "table":
            flow.block(2)
            self.table(element, flow, visible)
            flow.block(2)
        elif tag in ("ul", "ol", "menu"):
            self.list(element, flow, visible, verbatim)
        elif tag == "select":
            self.chosen(element, flow, visible)
        elif tag in BLOCKS:
            breaks = 2 if tag in SPACED else 1
            flow.block(breaks)
            if tag == "details" and "open" not in element.attributes:
                for child in element.children:
                    if isinstance(child, Element) and child.tag == "summary":
                        self.element(child, flow, visible, verbatim)
                        break
            elif tag in ("dd", "blockquote"):
                flow.indent += "  "
                self.children(element, flow, visible, verbatim)
                flow.end_line()
                flow.indent = flow.indent[:-2]
            elif tag in ("pre", "listing", "xmp"):
                first = element.children and element.children[0]
                if isinstance(first, str) and first.startswith("\n"):
                    element.children[0] = first[1:]
                self.children(element, flow, visible, True)
            else:
                self.children(element, flow, visible, verbatim)
            flow.block(breaks)
        else:
            self.children(element, flow, visible, verbatim or tag == "textarea")

    def list(self, element: Element, flow: Flow, visible: bool, verbatim: bool) -> None:
        breaks = 1 if flow.indent else 2
        flow.block(breaks)
        start = element.attributes.get("start", "1")
        number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
        for child in element.children:
            if isinstance(child, Element) and child.tag == "li":
                shown, seen = self.visibility.of(child, visible)
                if not shown:
                    continue
                marker = f"{number}. " if element.tag == "ol" else "- "
                number += 1
                flow.block(1)
                flow.indent += " " * len(marker)
                flow.marker = marker if seen else ""
                self.children(child, flow, seen, verbatim)
                if flow.marker:  # an item without text
                    flow._begin()
                flow.block(1)
                flow.indent = flow.indent[: -len(marker)]
            elif isinstance(child, Element):
                self.element(child, flow, visible, verbatim)
            elif visible:
                flow.text(child)
        flow.block(breaks)

    def chosen(self, element: Element, flow: Flow, visible: bool) -> None:
        options, todo = [], [element]
        while todo:
            for child in reversed(todo.pop().children):
                if isinstance(child, Element):
                    todo.append(child)
                    if child.tag == "option":
                        options.append(child)
        options.reverse()
        picked = next((o for o in options if "selected" in o.attributes), options[0] if options else None)
        if picked is not None:
            flow.text(" ")
            self.children(picked, flow, visible, False)
            flow.text(" ")

    def table(self, element: Element, flow: Flow, visible: bool) -> None:
        grid: list[list[str]] = []
        filled: dict[tuple[int, int], str] = {}
        for part in self._rows(element, visible):
            if isinstance(part[0], str):  # a caption or stray content
                flow.rows([part[0]])
                continue
            cells, seen = part
            row, column = len(grid), 0
            line: list[str] = []
            for cell in cells:
                shown, own = self.visibility.of(cell, seen)
                if not shown:
                    continue
                while (row, column) in filled:
                    line.append(filled.pop((row, column)))
                    column += 1
                inner = Flow()
                self.children(cell, inner, own, False)
                line.append(_SPACE.sub(" ", inner.result()).strip(" "))
                wide, high = (self._span(cell, n) for n in ("colspan", "rowspan"))
                line.extend([""] * (wide - 1))
                for down in range(1, high):
                    for right in range(wide):
                        filled[(row + down, column + right)] = ""
                column += wide
            while (row, column) in filled:
                line.append(filled.pop((row, column)))
                column += 1
            grid.append(line)
        grid = [r for r in grid if any(r)]
        widths = [max((len(r[c]) for r in grid if c < len(r)), default=0) for c in range(max(map(len, grid), default=0))]
        flow.rows([" | ".join(t.ljust(widths[c]) for c, t in enumerate(r)).rstrip(" ") for r in grid])

    @staticmethod
    def _span(cell: Element, name: str) -> int:
        value = cell.attributes.get(name, "1")
        return max(1, min(100, int(value))) if value.isascii() and value.isdigit() else 1

    def _rows(self, element: Element, visible: bool) -> Iterator[tuple]:
        """(cells, visible) of each row, and (text,) of what stands between the rows."""
        for child in element.children:
            if isinstance(child, str):
                if visible and child.strip():
                    yield (_SPACE.sub(" ", child).strip(" "),)
                continue
            shown, seen = self.visibility.of(child, visible)
            if not shown:
                continue
            if child.tag == "tr":
                cells = [c for c in child.children if isinstance(c, Element) and c.tag in ("td", "th")]
                other = Element("div", {})
                other.children = [c for c in child.children if not (isinstance(c, Element) and c.tag in ("td", "th"))]
                yield from self._stray(other, seen)
                yield cells, seen
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from self._rows(child, seen)
            elif child.tag not in ("col", "colgroup"):
                yield from self._stray(child, seen)

    def _stray(self, element: Element, visible: bool) -> Iterator[tuple]:
        inner = Flow()
        self.children(element, inner, visible, False)
        if text := _SPACE.sub(" ", inner.result()).strip(" "):
            yield (text,)


def visible_text(html: str | None) -> str:
    """The visible text of a page, laid out in lines."""
    if not html:
        return ""
    root, sheets = parse(html.replace("\x00", ""))
    flow = Flow()
    Renderer(Visibility(sheets)).children(root, flow, True, False)
    return flow.result()


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [visible_text(page.as_py()) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])


def render_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id``, the visible ``text`` and its numbers of characters and lines."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(_rendered, "page_id bigint, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return found.select("page_id", "text", F.length("text").cast("bigint").alias("n_chars"), lines.cast("bigint").alias("n_lines"))


def op7_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_pages(table(spark, sf_dir, "pages"))


ENTRIES = {"op7_layout_text": (op7_layout_text, None)}
