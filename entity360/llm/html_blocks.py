"""Blocks of text in a web page, each with its place: article, frame (menus and the like), or other.

Some frames are sure (their tag, their role, hidden), others a guess: a class or id with one of FRAME_WORDS,
or a form. If a page has no article outside frames, guessed frames around an article are undone, those
around the articles that fewest of them hold, unless the page has more text outside
frames than this article. Names like no-comments or has-sidebar tell a state and are no guess; body, html and
main are never a frame by their name. A form around nav, footer, main or article is the page itself.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

ARTICLE, FRAME, OTHER = "article", "frame", "other"

# Elements by what they mean for the text of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set(
    "script style title noscript template iframe object svg canvas audio video textarea select "
    "button datalist".split()
)
FRAMES = set("nav footer aside form dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS_AND_PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6".split())
FRAME_WORDS = set(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice overlay pagination popup promo promoted related replies share sharing "
    "sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget".split()
)
FRAME_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split()
)

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S
)
_ATTRIBUTE = re.compile(
    r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?"""
)
_WORD = re.compile(r"[a-z]+")
_STATE = re.compile(r"(?:no|not|has|have|with|without|is)[-_]")
SURE, GUESS = "sure", "guess"
IN_A_PAGE = set("nav footer main article".split())


class Block(NamedTuple):
    place: str
    text: str


def _attributes(text: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)
    }


def _is_article(tag: str, found: dict[str, str]) -> bool:
    role, item = found.get("role", "").lower(), found.get("itemprop", "").lower()
    return tag in ("article", "main") or role in ("main", "article") or item == "articlebody"


def _frame(tag: str, found: dict[str, str], inside: str) -> str:
    """Whether an element within a place is a frame: SURE, GUESS, or empty if it is none."""
    if tag in ("html", "body"):
        return ""
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true"
    hidden |= "display:none" in found.get("style", "").replace(" ", "").lower()
    if hidden or (tag in FRAMES and tag != "form") or role in FRAME_ROLES - {"form"}:
        return SURE
    if inside != ARTICLE and tag == "header":
        return SURE
    if tag == "form" or role == "form":
        return GUESS
    names = (found.get("class", "") + " " + found.get("id", "")).lower().split()
    words = {w for name in names if not _STATE.match(name) for w in _WORD.findall(name)}
    if tag != "main" and (words & FRAME_WORDS or inside != ARTICLE and "header" in words):
        return GUESS
    return ""


def blocks(page: str) -> list[Block]:
    """The non-empty blocks in page order, character references decoded, white space as one space."""
    found, forms, around = _parsed(page, frozenset())
    if forms:
        found, _, around = _parsed(page, forms)
    if around and not any(b.place == ARTICLE for b in found):
        again, _, _ = _parsed(page, forms | around)
        if _size(again, ARTICLE) >= _size(found, OTHER):
            return again
    return found


def _size(found: list[Block], place: str) -> int:
    return sum(len(b.text) for b in found if b.place == place)


def _parsed(page: str, undone: frozenset[int]) -> tuple[list[Block], frozenset[int], frozenset[int]]:
    """The blocks; the places of forms that are the page itself; those of the guessed frames around
    the articles that fewest hold. undone: the places of elements that are no frames."""
    out: list[Block] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = [("", OTHER)]
    #: Guessed frames among the open elements: depth and place; sure: depth of the outermost sure one.
    guesses: list[tuple[int, int, str]] = []
    sure = 0
    forms: set[int] = set()
    around: list[int] | None = None
    at = 0

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(stack[-1][1], text))
            held.clear()

    def cut(k: int) -> None:
        nonlocal sure
        del stack[k:]
        while guesses and guesses[-1][0] >= k:
            guesses.pop()
        if sure >= k:
            sure = 0

    def close(name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == name:
                if name in BLOCKS or any(tag in BLOCKS for tag, _ in stack[k:]):
                    flush()
                cut(k)
                return

    while m := _TAG.search(page, at):
        if m.start() > at:
            held.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            close(name)
            continue
        if name in NO_TEXT and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            held.append(" ")
        if name in BLOCKS:
            flush()
            if stack[-1][0] == "head":
                cut(len(stack) - 1)
            if any(tag == "p" for tag, _ in stack):  # a block ends an open paragraph
                close("p")
        if name in VOID or m[3].endswith("/"):
            continue
        inside, found = stack[-1][1], _attributes(m[3]) if m[3].strip() else {}
        kind = "" if m.start() in undone else _frame(name, found, inside)
        if name in IN_A_PAGE and guesses and not sure:
            forms.update(start for _, start, tag in guesses if tag == "form")
        if kind == SURE:
            sure = sure or len(stack)
        elif kind == GUESS and inside != ARTICLE and not sure:
            guesses.append((len(stack), m.start(), name))
        place = FRAME if kind or inside == FRAME else inside
        if _is_article(name, found):
            if place != FRAME:
                place = ARTICLE
            elif guesses and not sure and (around is None or len(guesses) < len(around)):
                around = [start for _, start, _ in guesses]
        if place != stack[-1][1]:
            flush()
        stack.append((name, place))
    if at < len(page):
        held.append(html.unescape(page[at:]))
    flush()
    return out, frozenset(forms), frozenset(around or ())
