"""A tolerant HTML reader: the elements of a page as a table, and its text as pieces of blocks."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
LISTS = frozenset("ul ol dl table".split())

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<close>>|\Z)|<[!?/](?=[^\s])[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+")


class Page(NamedTuple):
    tags: list[str]
    parents: list[int]  # -1 for the root
    depths: list[int]
    tokens: list[list[str]]  # words of class, id and role
    pieces: list[tuple[int, int, bool, str]]  # block, element, within a link, text


def read(source: str) -> Page:
    """Elements in page order, without plain inline ones, and the text pieces of the innermost kept element.

    Scripts, styles, titles and other raw elements lose their text. A tag that the end of the page cuts off is dropped; a
    character reference that it cuts off is decoded as far as the standard allows.
    """
    tags, parents, depths, tokens, pieces = ["#page"], [-1], [0], [[]], []
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements; an inline one has its parent's number
    links, block, at = 0, 0, 0

    def text(end: int) -> None:
        if end > at:
            pieces.append((block, stack[-1][1], links > 0, html.unescape(source[at:end])))

    def close(to: int) -> None:
        nonlocal links
        for name, _ in stack[to:]:
            links -= name == "a"
        del stack[to:]

    position = 0
    while found := _MARKUP.search(source, position):
        text(found.start())
        at = position = found.end()
        tag = found["tag"]
        if tag is None or not found["close"]:
            continue
        tag = tag.lower()
        if found["end"]:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if tag not in INLINE:
                block += 1
            if place:
                close(place)
            continue
        if tag in CLOSES_P and any(name == "p" for name, _ in stack):
            close(next(i for i, (name, _) in enumerate(stack) if name == "p"))
        if tag in SAME_CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in SAME_CLOSES[tag]:
                    close(i)
                    break
                if stack[i][0] in LISTS:
                    break
        names = [t for groups in _ATTR.findall(found["attrs"]) for t in _TOKEN.findall("".join(groups).lower())]
        if tag == "br":
            pieces.append((block, stack[-1][1], False, " "))
        if tag in VOID:
            block += tag not in INLINE
            continue
        if tag in RAW:
            shut = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, position)
            at = position = shut.start() if shut else len(source)
            if shut and (rest := source.find(">", position)) >= 0:
                at = position = rest + 1
            elif shut:
                at = position = len(source)
            continue
        if tag in INLINE and not names:
            stack.append((tag, stack[-1][1]))
        else:
            block += tag not in INLINE
            parent = stack[-1][1]
            tags.append(tag), parents.append(parent), depths.append(depths[parent] + 1), tokens.append(names)
            stack.append((tag, len(tags) - 1))
        links += tag == "a"
    text(len(source))
    return Page(tags, parents, depths, tokens, pieces)


def joined(page: Page, kept) -> str:
    """The text of the kept elements: white space of a block as one space, blocks on lines of their own."""
    blocks: dict[int, list[str]] = {}
    for block, element, _, text in page.pieces:
        if kept[element]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)
