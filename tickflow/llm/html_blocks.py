"""Leaf blocks of HTML pages: runs of text between block-level tags, with where they stand."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass

# Fixed values of HTML: elements that only style text, elements without an end, elements whose
# content is no text, and what a new element ends by itself.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style template textarea".split())
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)                                         # comment
      | <!\[CDATA\[.*?(?:\]\]>|\Z)
      | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)
        (?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>                 # tag
      | <(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)> # tag with a stray quote
      | <[/!?a-zA-Z][^>]*+(?:>|\Z)                                  # anything else in brackets
    """,
    re.S | re.X,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r"""\bdata-main(="no")?""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


@dataclass(slots=True, eq=False)
class Around:
    """An open element: its tag, the class, id and role words it adds to those around it, whether
    its tag is new among those around it, whether it is marked as main text, and its parent."""

    parent: Around | None
    tag: str
    names: tuple[str, ...]
    new_tag: bool
    marked: bool


@dataclass(slots=True)
class Block:
    """A run of text, the element it stands in, and how much of it is inside links."""

    text: str
    around: Around
    linked: float

    @property
    def marked(self) -> bool:
        return self.around.marked

    def _path(self) -> list[Around]:
        found, at = [], self.around
        while at.parent is not None:
            found.append(at)
            at = at.parent
        return found[::-1]

    @property
    def tags(self) -> tuple[str, ...]:
        """The tags around it from the outside in."""
        return tuple(element.tag for element in self._path())

    @property
    def names(self) -> frozenset[str]:
        """The class, id and role words around it."""
        return frozenset(name for element in self._path() for name in element.names)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, white space collapsed, character references decoded.

    Scripts, styles, templates, text fields, comments and markup are dropped; a ``br`` is white space.
    Missing end tags are supplied, stray ones ignored, and a tag that the page's end cuts off is
    dropped. Elements marked ``data-main`` are main text, for labelled pages, up to ones marked
    ``data-main="no"``. Time and memory grow with the page's length, however deep it is.
    """
    found: list[Block] = []
    stack: list[Around] = [Around(None, "", (), False, False)]
    depths: dict[str, list[int]] = {}
    open_names: dict[str, int] = {}
    held: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked, links
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            total = sum(len(part) for part in held)
            found.append(Block(text, stack[-1], linked / total))
        held.clear()
        linked = links = 0

    def innermost(names: Iterable[str]) -> int:
        return max((depths[name][-1] for name in names if depths.get(name)), default=0)

    def close(names: Iterable[str], until: Iterable[str] = ()) -> None:
        """End the innermost element of one of these names, and all inside it."""
        depth = innermost(names)
        if depth <= innermost(until):
            return
        for element in stack[depth:]:
            depths[element.tag].pop()
            for name in element.names:
                del open_names[name]
        del stack[depth:]

    def begin(tag: str, rest: str) -> None:
        own = {word.lower() for values in _NAMES.findall(rest) for value in values for word in _WORD.findall(value)}
        label = _LABEL.search(rest)
        marked = label[1] is None if label else stack[-1].marked
        new = tuple(sorted(name for name in own if name not in open_names))
        open_names.update(dict.fromkeys(new, 1))
        opened = depths.setdefault(tag, [])
        stack.append(Around(stack[-1], tag, new, not opened, marked))
        opened.append(len(stack) - 1)

    position = 0
    while position < len(page):
        match = _TOKEN.search(page, position)
        text = page[position : match.start()] if match else page[position:]
        if text:
            held.append(text)
            if links:
                linked += len(text)
        if not match:
            break
        position = match.end()
        name = match["name"] or match["name2"]
        if name is None:
            continue
        name, rest = name.lower(), match["rest"] or match["rest2"] or ""
        if match["end"] or match["end2"]:
            if name == "a":
                links = 0
            elif name not in INLINE and name not in VOID:
                flush()
                close((name,))
        elif name in DROPPED:
            stop = re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I).search(page, position)
            position = stop.end() if stop else len(page)
        elif name == "br":
            held.append(" ")
        elif name in INLINE:
            links = 1 if name == "a" else links
        else:
            flush()
            if name in _ENDS_PARAGRAPH:
                close(("p",), frozenset(("td", "th", "table", "button")))
            if name in ENDS:
                close(ENDS[name], frozenset(("ul", "ol", "dl", "table", "select")))
            if name not in VOID:
                begin(name, rest)
    flush()
    return found
