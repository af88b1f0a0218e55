"""Leaf blocks of HTML pages: stretches of text between block borders, with what stands above them.

Broken markup is normal: end tags may be missing or have no start, and pages may stop anywhere. Only the elements
whose text is raw run to the end of the page without an end tag; every other one closes with its parent.
"""

import html
import re
from collections.abc import Mapping
from typing import NamedTuple

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>?"
    # A value runs to its closing quote; where the page has none, the quote is like any other character.
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?>[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)""",
    re.S | re.I,
)
#: Skipped elements whose text is no markup, and where each ends.
RAW = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I) for tag in ("script", "style", "textarea", "title", "iframe")
}
#: Skipped elements that hold elements.
SKIPPED = frozenset("noscript template svg object select option button".split())
#: Of these, what a new one of another or the same kind ends.
SKIPPED_ENDS = {"option": {"option"}, "optgroup": {"option"}, "select": {"option", "select"}, "button": {"button"}}
#: Tags that cannot stand in an image and so end it, and the image's own elements that hold page text.
NOT_IN_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p"
    " pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HTML_IN_SVG = frozenset(("foreignobject", "desc"))
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Block tags that one of the same kind ends, and what a new block ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


class Above:
    """Tags and name words of an element and those above it; an element holds only the names that it adds."""

    __slots__ = ("parent", "new")

    def __init__(self, parent: "Above | None" = None, new: frozenset = frozenset()):
        self.parent, self.new = parent, new

    def under(self, names) -> "Above":
        """With the names of one more element inside."""
        return Above(self, frozenset(n for n in names if n not in self))

    def __iter__(self):
        at = self
        while at is not None:
            yield from at.new
            at = at.parent

    def __contains__(self, name: str) -> bool:
        return any(name == n for n in self)

    def __eq__(self, other) -> bool:
        """Equal to a set of the same names; elements are told apart."""
        return set(self) == other if isinstance(other, (set, frozenset)) else self is other

    __hash__ = object.__hash__


class Block(NamedTuple):
    text: str
    above: Above
    tag: str  # of the nearest block element
    linked: int  # characters inside links


def levels(page: list[Block]) -> tuple[list[Above], list[int], list[int]]:
    """(elements above any block, each after its parent; the place of each one's parent or -1; the place of each block's)."""
    place: dict[Above | None, int] = {None: -1}
    order: list[Above] = []
    for block in page:
        path, at = [], block.above
        while at not in place:
            path.append(at)
            at = at.parent
        for at in reversed(path):
            place[at] = len(order)
            order.append(at)
    return order, [place[a.parent] for a in order], [place[b.above] for b in page]


def sums_above(page: list[Block], values: Mapping[str, float]) -> list[float]:
    """For each block the sum of the values of the names above it."""
    order, parents, places = levels(page)
    sums: list[float] = []
    for above, parent in zip(order, parents):
        own = sum(values.get(name, 0.0) for name in sorted(above.new))
        sums.append(own + (sums[parent] if parent >= 0 else 0.0))
    return [sums[at] for at in places]


def without(page: list[Block], names: frozenset) -> list[Block]:
    """The same blocks, with these names nowhere above them."""
    order, parents, places = levels(page)
    changed: list[Above] = []
    for above, parent in zip(order, parents):
        changed.append(Above(changed[parent] if parent >= 0 else None, above.new - names))
    return [b._replace(above=changed[at]) for b, at in zip(page, places)]


def _own(tag: str, attributes: str) -> set[str]:
    found = {f"t:{tag}"}
    if attributes and "=" in attributes:
        names = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
        found.update(f"n:{w.lower()}" for w in WORD.findall(names))
    return found


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks in page order, with character references decoded and white space joined."""
    page = page or ""
    found: list[Block] = []
    #: Block elements, each with how many inline elements are open right inside it.
    stack: list[tuple[str, Above, dict[str, int]]] = [("", Above(), {})]
    names: set[str] = set()  # above the place reached
    open_tags: dict[str, int] = {}  # how many block elements of each kind
    #: The outermost skipped element and what is open inside it, each with whether what follows belongs to an image.
    skipped: list[tuple[str, bool]] = []
    counts: dict[str, int] = {}  # of the tags there
    text: list[str] = []
    linked, link_depth, at = 0, 0, 0

    def close_from(depth: int):
        for tag, above, _ in stack[depth:]:
            names.difference_update(above.new)
            open_tags[tag] -= 1
        del stack[depth:]

    def flush():
        nonlocal linked
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                found.append(Block(whole, stack[-1][1], stack[-1][0], min(linked, len(whole))))
            text.clear()
        linked = 0

    def add(part: str):
        nonlocal linked
        if part and not skipped:
            text.append(part)
            if link_depth:
                linked += len(part)

    def in_svg() -> bool:
        return bool(skipped) and skipped[-1][1]

    def push(tag: str):
        skipped.append((tag, tag == "svg" or (in_svg() and tag not in HTML_IN_SVG)))
        counts[tag] = counts.get(tag, 0) + 1

    def pop() -> str:
        tag, _ = skipped.pop()
        counts[tag] -= 1
        return tag

    def leave():
        skipped.clear()
        counts.clear()

    def skip(end: str, tag: str, closed: bool) -> bool:
        """Whether the tag belongs to the skipped element; if not, that element is closed."""
        if end:
            if counts.get(tag):
                while pop() != tag:
                    pass
                return True
            if tag in stack[-1][2] or open_tags.get(tag):
                leave()
                return False
            return True
        if skipped[-1][0] in SKIPPED_ENDS.get(tag, ()):
            while skipped and skipped[-1][0] in SKIPPED_ENDS[tag]:
                pop()
        elif tag == "body" or (tag in NOT_IN_SVG and skipped[0][0] == "svg" and in_svg()):
            leave()
        if skipped and not closed and tag not in VOID:
            push(tag)
        return bool(skipped)

    while match := TAG.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        end, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not in_svg():
            if not end:
                close = RAW[tag].search(page, at)
                at = close.end() if close else len(page)
                if tag != "title" and not skipped:
                    text.append(" ")
            continue
        closed = attributes.endswith("/")
        if skipped and skip(end, tag, closed):
            continue
        if tag in SKIPPED:
            text.append(" ")
            if not end and not closed:
                push(tag)
            continue
        if tag in INLINE:
            if tag == "a":
                link_depth = 0 if end else 1
            elif tag == "br":
                text.append(" ")
            inside = stack[-1][2]
            if not end:
                if tag not in VOID:
                    inside[tag] = inside.get(tag, 0) + 1
            elif inside.get(tag, 0) > 1:
                inside[tag] -= 1
            else:
                inside.pop(tag, None)
            continue
        flush()
        link_depth = 0
        if end:
            if open_tags.get(tag):
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                close_from(depth)
            continue
        if tag in VOID or closed:
            continue
        if stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            close_from(len(stack) - 1)
        if len(stack) > 1 and stack[-1][0] in ENDS.get(tag, ()):
            close_from(len(stack) - 1)
        new = frozenset(_own(tag, attributes) - names)
        names |= new
        open_tags[tag] = open_tags.get(tag, 0) + 1
        stack.append((tag, Above(stack[-1][1], new), {}))
    add(page[at:])
    flush()
    return found
