"""Small tolerant reader for one HTML page, used only inside the Arrow functions in ``pages``.

A page becomes a flat list of items; an element is a span of that list. Nothing nests, so deep or
broken markup costs neither recursion nor memory beyond the page itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html import escape, unescape

TEXT, RAW, COMMENT, OPEN, CLOSE = range(5)

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW_TEXT = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in ("script", "style")}
# Starting one of these ends an open paragraph.
_BLOCK = frozenset(
    "address blockquote center dd div dl dt fieldset form h1 h2 h3 h4 h5 h6 hr li ol p pre table "
    "tbody td tfoot th thead tr ul".split()
)
# Starting the key ends the nearest open element in the first set, unless one in the second is met.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
# An end tag does not reach through an open element that is stronger than itself.
_STRENGTH = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
             "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
_STRONGER = {tag: [t for t, s in _STRENGTH.items() if s > own] for tag, own in _STRENGTH.items()}

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]++|=(?!\s*[\"']))*+)>"
    r"|<[!?][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SELECTOR = re.compile(r"([a-z0-9]*)(?:#([\w-]+))?(?:\.([\w-]+))?(?:\[(\w+)=([\w-]+)\])?")
_CHARSET = re.compile(rb"<\s*meta[^>]+charset\s*=\s*[\"']?([\w-]+)", re.I)
_BOMS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))


def decode(payload: bytes) -> str:
    """Byte order mark, then declared charset, then UTF-8, then windows-1252."""
    for mark, encoding in _BOMS:
        if payload.startswith(mark):
            return payload[len(mark) :].decode(encoding, "replace")
    declared = _CHARSET.search(payload)
    for encoding in ([declared[1].decode("ascii")] if declared else []) + ["utf-8"]:
        try:
            return payload.decode(encoding)
        except (LookupError, ValueError):  # also a codec that cannot decode at all
            continue
    return payload.decode("windows-1252", "replace")


# Attributes by their text: pages of a source repeat a few. Bounded in number and length.
_read: dict[str, dict[str, str]] = {}
_MOST_READ, _LONGEST_READ = 1 << 12, 256


def _attributes(source: str) -> dict[str, str]:
    known = _read.get(source)
    if known is None:
        known = {}
        for name, double, single, bare in _ATTRIBUTE.findall(source):
            known.setdefault(name.lower(), unescape(double or single or bare))
        if len(source) <= _LONGEST_READ:
            if len(_read) >= _MOST_READ:
                _read.clear()
            _read[source] = known
    return known


# Tags by their text, as above.
_cut: dict[str, tuple[str, str, str]] = {}


def _tag(token: str) -> tuple[str, str, str] | None:
    """(slash, name, attributes) of a text from "<" to the first ">" if that is a whole tag: one whose
    quoted values all end in it."""
    known = _cut.get(token)
    if known is None and len(token) <= _LONGEST_READ:
        match = _TOKEN.fullmatch(token)
        if match and match["tag"] is not None:
            known = match["end"], match["tag"], match["attrs"]
            if len(_cut) >= _MOST_READ:
                _cut.clear()
            _cut[token] = known
    return known


class Element:
    """Items [first, last] of a page; its descendants are elements [index + 1, stop).

    Most elements are only ever looked at by tag, so attributes are read when first asked for.
    """

    __slots__ = ("_attrs", "first", "index", "last", "source", "stop", "tag")

    def __init__(self, tag: str, source: str, first: int, index: int) -> None:
        self.tag, self.source, self._attrs = tag, source, None
        self.first, self.last, self.index, self.stop = first, first, index, index + 1

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = _attributes(self.source)
        return self._attrs

    def may_have(self, value: str) -> bool:
        """Quick look before attributes are read: the value cannot be there if its text is not."""
        return value in self.source or "&" in self.source


class Page:
    def __init__(self, markup: str) -> None:
        self.items: list[tuple[int, object]] = []
        self.elements: list[Element] = []
        self._tagged: dict[str, list[Element]] = {}
        self._open: list[Element] = []
        self._depths: dict[str, list[int]] = {}
        self._templates = 0
        self._read(markup)

    def _read(self, markup: str) -> None:
        position, limit = 0, markup.rfind(">") + 1  # no tag can end after the last ">"
        items, opened, find = self.items, self._open, markup.find
        while (start := find("<", position, limit)) >= 0:
            stop = find(">", start, limit) + 1
            known = _tag(markup[start:stop])
            if known is None:
                match = _TOKEN.search(markup, start, limit)
                if not match:
                    break
                start, stop = match.span()
                known = match["end"], match["tag"], match["attrs"]
            if start > position:
                self._text(markup[position:start])
            position = stop
            end, tag, attributes = known
            if tag is None:
                if match["comment"] is not None:
                    if not match[0].endswith("-->"):
                        position = len(markup)
                    items.append((COMMENT, markup[match.start("comment") : position].removesuffix("-->")))
                continue
            tag = tag.lower()
            if not end:
                self._start(tag, attributes)
                if tag in _RAW_TEXT:
                    close = _RAW_TEXT[tag].search(markup, position)
                    after = close.start() if close else len(markup)
                    items.append((RAW, markup[position:after]))
                    position = after
            elif opened and opened[-1].tag == tag:
                self._close_last()
            else:
                self._end_nearest((tag,), _STRONGER.get(tag, _STRENGTH))
        self._text(markup[position:])
        self._close_down_to(0)

    def _text(self, text: str) -> None:
        if text:
            self.items.append((RAW if self._templates else TEXT, unescape(text) if "&" in text else text))

    def _start(self, tag: str, attributes: str) -> None:
        depths, opened = self._depths, self._open
        if tag in _BLOCK and depths.get("p"):
            self._end_nearest(("p",), ("table", "td", "th"))
        if tag in _ENDS:
            self._end_nearest(*_ENDS[tag])
        element = Element(tag, attributes, len(self.items), len(self.elements))
        self.elements.append(element)
        self.items.append((OPEN, element))
        if tag in depths:
            depths[tag].append(len(opened))
            self._tagged[tag].append(element)
        else:
            depths[tag], self._tagged[tag] = [len(opened)], [element]
        opened.append(element)
        if tag == "template":
            self._templates += 1
        elif tag in _VOID:
            self._close_last()

    def _nearest(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the tags, -1 when there is none."""
        nearest = -1
        for tag in tags:
            depths = self._depths.get(tag)
            if depths and depths[-1] > nearest:
                nearest = depths[-1]
        return nearest

    def _end_nearest(self, targets: Iterable[str], walls: Iterable[str]) -> None:
        depth = self._nearest(targets)
        if depth >= 0 and depth > self._nearest(walls):
            self._close_down_to(depth)

    def _close_down_to(self, depth: int) -> None:
        while len(self._open) > depth:
            self._close_last()

    def _close_last(self) -> None:
        element = self._open.pop()
        tag = element.tag
        self._depths[tag].pop()
        element.last, element.stop = len(self.items), len(self.elements)
        self.items.append((CLOSE, element))
        if tag == "template":
            self._templates -= 1

    def select(self, selector: str, scope: Element | None = None) -> Iterator[Element]:
        """Elements in document order for one or two simple selectors ("a.next", "h2.title a")."""
        outer, _, inner = selector.partition(" ")
        matches, tag = matcher(outer), _leading_tag(outer)
        if scope:
            found = self.elements[scope.index + 1 : scope.stop]
        else:
            found = self._tagged.get(tag, ()) if tag else self.elements
        for element in found:
            if (not tag or element.tag == tag) and matches(element):
                if inner:
                    yield from self.select(inner, element)
                else:
                    yield element

    def own_texts(self, element: Element) -> list[str]:
        """Text pieces directly inside an element, not those of its children."""
        texts, index = [], element.first + 1
        while index < element.last:
            kind, data = self.items[index]
            if kind == OPEN:
                index = data.last
            elif kind in (TEXT, RAW):
                texts.append(data)
            index += 1
        return texts

    def text(self, element: Element, dropped: frozenset[int] | set[int] = frozenset()) -> str:
        """Text under an element, each piece stripped, without scripts, styles and dropped parts."""
        pieces, index = [], element.first
        while index < element.last:
            kind, data = self.items[index]
            if kind == TEXT:
                pieces.append(data.strip())
            elif index in dropped:
                index = data.last
            index += 1
        return "".join(pieces)

    def render(self, root: Element, dropped: set[int], kept_attributes: frozenset[str]) -> str:
        """Markup of an element without the elements that start at a ``dropped`` item."""
        out, index = [], root.first
        while index <= root.last:
            kind, data = self.items[index]
            if kind == OPEN:
                if index in dropped:
                    index = data.last + 1
                    continue
                attrs = "".join(
                    f" {name}={_quoted(value)}"
                    for name, value in data.attrs.items()
                    if name in kept_attributes
                )
                out.append(f"<{data.tag}{attrs}{'/' if data.tag in _VOID else ''}>")
            elif kind == CLOSE:
                if data.tag not in _VOID:
                    out.append(f"</{data.tag}>")
            elif kind == COMMENT:
                out.append(f"<!--{data}-->")
            else:
                out.append(escape(data, quote=False))
            index += 1
        return "".join(out)


def _quoted(value: str) -> str:
    value = escape(value, quote=False)
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"' + value.replace('"', "&quot;") + '"'


_tags: dict[str, str] = {}


def _leading_tag(selector: str) -> str:
    """The tag of a simple selector, empty where it names none."""
    if selector not in _tags:
        _tags[selector] = _SELECTOR.fullmatch(selector)[1]
    return _tags[selector]


Test = Callable[[Element], bool]
_tests: dict[str | tuple[str, ...], Test] = {}


def matcher(selector: str) -> Test:
    """Test for one simple selector: a tag, "#id", ".class", "[name=value]" or tag plus one of them."""
    if selector not in _tests:
        _tests[selector] = _matcher(*_SELECTOR.fullmatch(selector).groups())
    return _tests[selector]


def _matcher(tag: str, ident: str, css_class: str, name: str, value: str) -> Test:
    wanted = ident or css_class or value
    if not wanted:
        return lambda element: element.tag == tag

    def matches(element: Element) -> bool:
        if (tag and element.tag != tag) or not element.may_have(wanted):
            return False
        if ident:
            return element.attrs.get("id") == ident
        if css_class:
            return css_class in element.attrs.get("class", "").split()
        return element.attrs.get(name) == value

    return matches


def any_matcher(selectors: tuple[str, ...]) -> Test:
    """Test for any of several simple selectors."""
    if selectors not in _tests:
        tags = frozenset(s for s in selectors if s.isalnum())
        others = [matcher(s) for s in selectors if s not in tags]
        _tests[selectors] = lambda e: e.tag in tags or (
            bool(e.source) and any(test(e) for test in others)
        )
    return _tests[selectors]
