"""Text blocks of an HTML page in order, with the elements they stand in."""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)

# Elements of HTML that begin a new line of text, and those without an end.
LINE = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("title select option textarea button".split())

#: Element names and words of classes and ids that tell what is around the article, and what holds it.
AROUND = frozenset(
    "nav header footer aside form menu navbar navigation sidebar side widget ad ads advert advertisement sponsor "
    "sponsored promo banner cookie cookies consent notice alert popup modal newsletter subscribe signup login search "
    "comment comments reply replies disqus share social related breadcrumb breadcrumbs pagination copyright head title "
    "button select textarea topbar masthead skip legal".split()
)
HOLDS = frozenset("article main content post entry story body-text articlebody maincontent".split())


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]  # names, classes and ids of the open elements, outermost first
    linked: int  # characters inside links


@lru_cache(maxsize=4096)
def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    words = [name]
    for _, value in ATTRIBUTE.findall(attributes):
        words += re.split(r"[\s_-]+", value.strip("\"'").lower())
    return tuple(w for w in words if w)


def blocks(page: str | None) -> list[Block]:
    """The blocks that have text: white space is one space, references are decoded."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = 0
    path: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path, linked))
            parts.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal links
        while stack:
            top = stack.pop()[0]
            links -= top == "a"
            if top == name:
                return

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            if not parts:
                path = tuple(t for _, tokens in stack for t in tokens)
            parts.append(piece := page[at : m.start()])
            linked += len(piece) if links > 0 else 0
        at = m.end()
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if m[2]:
            if name in LINE:
                flush()
            if any(open_ == name for open_, _ in stack):
                close(name)
            continue
        if name in LINE:
            flush()
            names = [open_ for open_, _ in stack]
            if "p" in names:  # a new line element ends a paragraph
                close("p")
            elif name in ("li", "tr", "td", "th", "dt", "dd", "option") and name in names:
                # the last open one of its kind ends, unless it holds the list or table that begins this one
                inner = names[len(names) - names[::-1].index(name) :]
                if not {"ul", "ol", "table", "dl", "select"} & set(inner):
                    close(name)
        elif name == "br":
            parts.append(" ") if parts else None
        if name not in VOID and not m[4].endswith("/"):
            stack.append((name, _tokens(name, m[4])))
            links += name == "a"
    if at < len(page):
        if not parts:
            path = tuple(t for _, tokens in stack for t in tokens)
        parts.append(page[at:])
    flush()
    return out


def supposed_main(path: tuple[str, ...]) -> bool:
    """What markup says about a block: inside something that holds the article, not in what is around."""
    depth = max((i for i, t in enumerate(path) if t in HOLDS), default=-1)
    return depth >= 0 and not any(t in AROUND for t in path)
