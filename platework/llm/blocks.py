"""HTML to leaf blocks: text between block tags with the path of open elements. Scripts, styles, iframes and comments
are no text; all else is, be it of formulas, drawings or fallbacks: the path tells what it is. Character references are
decoded; white space inside a block becomes one space."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe".split())
#: Inside these, ``/>`` ends any element.
FOREIGN = frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    # formulas are part of their sentence
    "annotation annotation-xml maction math menclose merror mfenced mfrac mglyph mi mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
    "none semantics".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
#: Opening one of these ends an open element of the same group.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</([a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>"
    r"|<[a-zA-Z/!?][^>]*$", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


class Node:
    """An open element: its own marks, and the element around it. Blocks share their way up, so that memory grows with the
    number of elements and not with their depth."""

    __slots__ = ("parent", "marks", "vector")

    def __init__(self, parent: Node | None, marks: tuple[str, ...]):
        self.parent, self.marks, self.vector = parent, marks, None


@dataclass
class Block:
    node: Node | None  # the innermost open element
    text: str = ""
    linked: int = 0  # characters inside links
    at: int = 0  # where its text begins in the source

    @property
    def path(self) -> tuple[str, ...]:
        """Marks of the open elements, outermost first: tag names and words of class, id and role."""
        found, node = [], self.node
        while node is not None:
            found.append(node.marks)
            node = node.parent
        return tuple(m for marks in reversed(found) for m in marks)


def marks(tag: str, attributes: str, known: dict[tuple[str, str], tuple[str, ...]]) -> tuple[str, ...]:
    """The tag, and the words of its class, id and role as ``.word``."""
    found = known.get((tag, attributes))
    if found is None:
        words = []
        for m in _NAMES.finditer(attributes):
            words += [w for w in _SPLIT.split((m[2] or m[3] or m[4] or "").lower()) if w]
        found = (tag, *("." + w for w in words))
        if len(known) < 100_000:
            known[tag, attributes] = found
    return found


def split(source: str, known: dict | None = None) -> list[Block]:
    """The leaf blocks in page order. An unfinished tag at the end is no text."""
    known = {} if known is None else known
    out: list[Block] = []
    stack: list[tuple[str, Node | None]] = []  # tag, innermost element that is no inline one
    links, at, parts, linked, begin = 0, 0, [], 0, 0

    def close_block():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1][1] if stack else None, text, linked, begin))
            parts, linked = [], 0

    def pop_to(place: int):
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[place:])
        del stack[place:]

    size = len(source)
    while at < size:
        m = _TOKEN.search(source, at)
        stop = m.start() if m else size
        if stop > at:
            if not parts:
                begin = at
            parts.append(source[at:stop])
            linked += links and stop - at
        if not m:
            break
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag not in INLINE:
                close_block()
            elif tag == "br":
                parts.append(" ")
            if tag in CLOSES_P:
                for place in range(len(stack) - 1, -1, -1):
                    if stack[place][0] == "p":
                        pop_to(place)
                        break
                    if stack[place][0] not in INLINE:
                        break
            if tag in SIBLINGS:
                for place in range(len(stack) - 1, -1, -1):
                    if stack[place][0] in SIBLINGS[tag]:
                        pop_to(place)
                        break
                    if stack[place][0] not in INLINE and stack[place][0] != "p":
                        break
            if tag in RAW and not (m[2].endswith("/") and any(t in FOREIGN for t, _ in stack)):
                end = re.compile(f"</{tag}[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
            elif tag not in VOID and not m[2].endswith("/"):
                around = stack[-1][1] if stack else None
                stack.append((tag, around if tag in INLINE else Node(around, marks(tag, m[2], known))))
                links += tag == "a"
        elif m[3]:
            tag = m[3].lower()
            if tag not in INLINE:
                close_block()
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == tag:
                    pop_to(place)
                    break
                if tag in INLINE and stack[place][0] not in INLINE:
                    break
    close_block()
    return out
