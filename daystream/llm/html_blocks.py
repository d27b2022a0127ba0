"""Blocks of a web page: the text between block-level tags, with where it stands."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: HTML's block-level, void and never-shown elements.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th thead title head tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
#: Never shown, but with markup inside.
NEVER = frozenset("noscript template svg math object canvas".split())
#: What a block-level start tag ends, as it can't be in them.
FOREIGN = frozenset(("svg", "math"))
#: Which open elements a start tag ends (the optional end tags).
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"), "option": ("option",)}
#: Elements that an optional end tag doesn't reach out of.
WALLS = frozenset("ul ol dl table article section div body html td th main aside nav footer header form blockquote select menu".split())
KEEPS_P = frozenset("html body head option optgroup button title".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<broken>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.S | re.I)
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDE = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Element:
    """An open element that says where a block stands, a block-level or a named one,
    and with its parents the path down to it: iterates over (tag, name parts), outermost first."""

    __slots__ = ("parent", "tag", "names", "depth", "seen")

    def __init__(self, parent: Element | None, tag: str, names: tuple[str, ...]):
        self.parent, self.tag, self.names = parent, tag, names
        self.depth = parent.depth + 1 if parent else 1
        self.seen = None    #: what a reader keeps here for the path down to this element

    def __iter__(self):
        out, e = [], self
        while e is not None:
            out.append((e.tag, e.names))
            e = e.parent
        return reversed(out)

    def __eq__(self, other):
        return self is other or (other is not None and tuple(self) == tuple(other))

    __hash__ = object.__hash__


class Block(NamedTuple):
    text: str           #: references decoded, white space runs one space, trimmed
    path: Element | None  #: its innermost open element, which knows its parents
    linked: int         #: characters of the text in links, about


def name_parts(attrs: str) -> tuple[str, ...]:
    """The lower-cased word parts of an element's class, id and role."""
    out = []
    for m in NAMED.finditer(attrs):
        out += [p.lower() for p in PART.findall(m[1])]
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The non-empty blocks of a page in page order.

    Scripts, styles, comments, markup and elements that are never shown are
    left out; an element with markup inside that isn't ended hides nothing.
    Unclosed and misnested tags are read as a browser would in the
    common cases; a page that breaks off keeps what came before. Blocks share
    their path's elements, so time and memory follow the length of the page, however
    deep it is.
    """
    page = page or ""
    # (tag, element of the path, hidden: 1 in an element hidden by attribute, 2 + its place in one that is never shown)
    stack: list[tuple] = []
    opened: dict[str, int] = {}  # how many elements of a tag are open
    ended: dict[str, int] = {}   # where the last end tag of an element that is never shown is
    out: list[Block] = []
    buffer: list[str] = []
    linked = 0
    at = 0

    def close():
        nonlocal linked
        if stack and stack[-1][2] >= 2:
            return               # the text around goes on
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append(Block(text, stack[-1][1] if stack else None, linked))
            buffer.clear()
        linked = 0

    def add(raw):
        nonlocal linked
        if raw and not (stack and stack[-1][2]):
            raw = html.unescape(raw) if "&" in raw else raw
            buffer.append(raw)
            if any(t == "a" for t, _, _ in stack[-4:]):
                linked += len(raw)

    def cut(i):
        for t, _, _ in stack[i:]:
            opened[t] -= 1
        del stack[i:]

    def end_of(tags, walls):
        if not any(opened.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                close()
                cut(i)
                return
            if stack[i][0] in walls:
                return

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if tag in BLOCK:
                close()
            elif tag == "br":
                buffer.append(" ")
            for i in range(len(stack) - 1 if opened.get(tag) else -1, -1, -1):
                if stack[i][0] == tag:
                    cut(i)
                    break
                if stack[i][0] in WALLS and tag not in BLOCK and tag not in NEVER:
                    break
            if tag in BLOCK:
                close()
        elif m["start"] or m["broken"]:
            tag, attrs = (m["start"] or m["broken"]).lower(), m["attrs"] or ""
            if not m.group().endswith(">"):
                break                # the page ends inside this tag
            if tag in BLOCK:
                if stack and stack[-1][2] >= 2:
                    outer = stack[-1][2] - 2
                    if stack[outer][0] in FOREIGN and not opened.get("foreignobject"):
                        cut(outer)
                close()
                shown = not (stack and stack[-1][2] >= 2)
                if shown and tag not in KEEPS_P:
                    end_of(("p",), WALLS)
                if shown and tag in ENDS:
                    end_of(ENDS[tag], frozenset(WALLS - set(ENDS[tag])))
            elif tag == "br":
                buffer.append(" ")
            if tag not in VOID and not attrs.endswith("/"):
                hidden = stack[-1][2] if stack and stack[-1][2] else int(bool(attrs and HIDE.search(attrs)))
                if tag in NEVER and not hidden:
                    if tag not in ended:
                        ended[tag] = max((x.start() for x in re.finditer(rf"</{tag}(?=[\s/>])", page, re.I)), default=-1)
                    hidden = 2 + len(stack) if ended[tag] >= m.end() else 0
                names = name_parts(attrs) if attrs else ()
                above = stack[-1][1] if stack else None
                stack.append((tag, Element(above, tag, names) if tag in BLOCK or names else above, hidden))
                opened[tag] = opened.get(tag, 0) + 1
    else:
        add(page[at:])
    close()
    return out
