"""Leaf blocks of a web page: their text, and where in the markup they stand."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

_SKIPPED = (r"<!--.*?(?:-->|\Z)"
            r"|<(script|style|noscript|template|svg|iframe|object|canvas|math)\b[^>]*>.*?(?:</\1\s*>|\Z)")
_TAG = r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
_OTHER = r"<[!?/a-zA-Z][^>]*>"
_MARKUP = re.compile(f"{_SKIPPED}|{_TAG}|{_OTHER}", re.S | re.I)
_UNENDING = re.compile(f"{_SKIPPED}|{_OTHER}", re.S | re.I)   # for a tag whose quotes leave it no end
_QUOTES = re.compile("[\"'>]")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn del em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends an open element of these kinds, as browsers have it.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS |= {tag: {"p"} for tag in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header "
         "hr main nav ol pre section table ul".split()}
# Elements that an implied end does not reach out of.
WALLS = frozenset("table ul ol dl div section article main aside nav body td th form footer header".split())


def _names(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role."""
    return tuple(f".{w}" for m in _NAMES.finditer(attributes)
                 for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower()))


PATH_BUCKETS = 192


@lru_cache(maxsize=1 << 16)
def bucket(name: str) -> int:
    return 1 << zlib.crc32(name.encode()) % PATH_BUCKETS


class Element:
    """An open element, linked to the one around it: what blocks share of their paths is held once."""

    __slots__ = ("up", "own", "depth", "last", "hashed")

    def __init__(self, up: Element | None, own: tuple[str, ...]):
        self.up, self.own = up, own           # own: the tag, and words of class, id and role
        self.depth = len(own) + (up.depth if up else 0)
        self.last = ((up.last if up else ()) + own)[-2:]
        self.hashed = up.hashed if up else 0  # buckets of all names from the root down, as bits
        for name in own:
            self.hashed |= bucket(name)


@dataclass
class Block:
    text: str
    at: Element | None      # the innermost element around it
    linked: int             # code points inside links

    @property
    def path(self) -> tuple[str, ...]:
        """Names from the root down."""
        names, e = [], self.at
        while e:
            names.append(e.own)
            e = e.up
        return tuple(name for own in reversed(names) for name in own)


class _Open:
    """The open elements that are not inline, and where the nearest of a kind stands, without searching for it."""

    def __init__(self):
        self.stack: list[tuple[str, Element]] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []

    def top(self) -> Element | None:
        return self.stack[-1][1] if self.stack else None

    def nearest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            self.places[tag].pop()
            if tag in WALLS:
                self.walls.pop()

    def begin(self, tag: str, names: tuple[str, ...]) -> None:
        ended = self.nearest(ENDS.get(tag, ()))
        if ended >= 0 and ended >= (self.walls[-1] if self.walls else 0):
            self.cut(ended)
        self.places[tag].append(len(self.stack))
        if tag in WALLS:
            self.walls.append(len(self.stack))
        self.stack.append((tag, Element(self.top(), (tag, *names))))

    def end(self, tag: str) -> None:
        place = self.nearest((tag,))
        if place >= 0:
            self.cut(place)


def _endings(html: str) -> tuple[list[int], list[bool]]:
    """Places of quotes and ``>``, and whether a tag that is read up to there (outside of quotes) has an end."""
    places = [m.start() for m in _QUOTES.finditer(html)]
    ends, following = [False] * (len(places) + 1), {}
    for k in range(len(places) - 1, -1, -1):
        sign = html[places[k]]
        if sign == ">":
            ends[k] = True
        else:
            ends[k] = sign in following and ends[following[sign] + 1]
            following[sign] = k
    return places, ends


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a whole page in order: character references decoded, white space runs made one blank.

    Scripts, styles and comments give nothing; a block ends at every tag that
    is not inline.  Markup may be cut off or unclosed, elements may be nested to
    any depth, and quotes may be left open: the time is in proportion to the page.
    """
    html = html or ""
    opened = _Open()
    found: list[Block] = []
    parts: list[str] = []
    endings: tuple[list[int], list[bool]] | None = None
    linked = at = links = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            found.append(Block(text, opened.top(), min(linked, len(text))))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text.strip())

    begin, bracket = html.find("<"), -1
    while begin >= 0:
        if bracket < begin:
            bracket = html.find(">", begin)
            if bracket < 0:  # no tag ends any more, only a comment may begin
                begin = html.find("<!--", begin)
                if begin < 0:
                    break
                bracket = len(html)
        markup = _MARKUP
        if endings and not endings[1][bisect_left(endings[0], begin)]:
            markup = _UNENDING
        mark = markup.match(html, begin)
        if mark is None:  # a sign, not a tag
            begin = html.find("<", begin + 1)
            continue
        add(html[at:begin])
        tag = (mark[3] or "").lower() if markup is _MARKUP else ""
        if not tag and endings is None and mark[1] is None and html[begin + 1].isalpha():
            endings = _endings(html)  # a tag without an end: the next ones are not read to the end of the page for that
        at = mark.end()
        begin = html.find("<", at)
        if not tag:
            continue
        if tag not in INLINE:
            close()
        if tag == "a":
            links = 0 if mark[2] else 1
        if tag in INLINE or (tag in VOID and not mark[2]):
            continue
        if mark[2]:
            opened.end(tag)
        else:
            opened.begin(tag, _names(mark[4]) if mark[4] else ())
    add(html[at:])
    close()
    return found
