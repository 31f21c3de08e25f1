"""Text lines of a web page, each with its place in the markup."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# Elements that begin and end a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no markup.
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes svg math object audio video canvas".split())
# Elements that are no part of an article, and words of class, id or role that say so of others.
CHROME = frozenset("head nav footer aside form menu dialog button select datalist".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies copyright dialog discussion disqus footer form gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice notices notification pager pagination popup promo promotion recommended related replies reply"
    " respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar topbar widget".split()
)
# Words of a class that say something of the page rather than of the element.
OF_PAGE = frozenset("has no not with without open closed disabled".split())
# Elements that hold the article even where their class names something else as well.
HOLDERS = frozenset("html body main article".split())
# An open element of the first kind ends before one of the second, within the element of the third kind.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Line(NamedTuple):
    """A block of text. ``chrome``: by its markup no part of an article; ``article`` and ``main``: within such an element;
    ``prose``: in an element for prose; ``links``: all of it is link text."""

    text: str
    path: str
    chrome: bool
    article: bool
    main: bool
    prose: bool
    links: bool


class _Open(NamedTuple):
    name: str
    path: str
    chrome: bool
    article: bool
    main: bool
    paragraph: int


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


def _is_chrome(name: str, attributes: dict[str, str], within: _Open) -> bool:
    if name in CHROME or (name == "header" and not within.article):
        return True
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
        return True
    named = [attributes.get(key, "") for key in ("class", "id", "role")]
    for label in " ".join(named).split():
        words = {word.lower() for word in _WORDS.findall(label)}
        if words & CHROME_WORDS and not words & OF_PAGE:
            return name not in HOLDERS or (name == "article" and bool(words & {"comment", "reply", "teaser", "related", "promo", "ad"}))
    return False


def text_lines(page: str) -> list[Line]:
    """Lines of text in page order, white space as single spaces and character references decoded.

    Unclosed elements end as browsers end them: paragraphs and items before the next block or item, all at the end of the
    element around them. Comments, scripts, styles and titles have no lines. One pass over the page.
    """
    lines: list[Line] = []
    stack = [_Open("", "", False, False, False, -1)]
    count: Counter[str] = Counter()
    parts: list[str] = []
    linked, unlinked, links = False, False, 0

    def end_line() -> None:
        nonlocal linked, unlinked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1]
                lines.append(Line(text, top.path, top.chrome, top.article, top.main, top.name in PROSE, linked and not unlinked))
        linked = unlinked = False

    def leave(depth: int) -> None:
        while len(stack) > depth:
            count[stack.pop().name] -= 1

    def enter(name: str, attributes: dict[str, str]) -> None:
        top = stack[-1]
        article = top.article or name == "article" or attributes.get("role") == "article" or attributes.get("itemprop") == "articleBody"
        main = top.main or name == "main" or attributes.get("role") == "main"
        paragraph = len(stack) if name == "p" else -1
        chrome = top.chrome or _is_chrome(name, attributes, top)
        stack.append(_Open(name, f"{top.path}/{name}"[-200:], chrome, article and not chrome, main, paragraph))
        count[name] += 1

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            parts.append(text)
            if not text.isspace():
                linked, unlinked = linked or links > 0, unlinked or links == 0
        if not found:
            break
        at = found.end()
        closing, name, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW and not closing:
            if rest.endswith("/"):
                continue
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name == "br":
            parts.append(" ")
        elif name == "a":
            links = max(0, links - 1) if closing else links + 1
        elif closing:
            if count[name] > 0 and (name in BLOCKS or stack[-1].name == name):
                end_line()
                depth = len(stack) - 1
                while stack[depth].name != name:
                    depth -= 1
                leave(depth)
        elif name in EMPTY:
            if name in BLOCKS:
                end_line()
        elif name in BLOCKS:
            end_line()
            if stack[-1].paragraph >= 0:
                leave(stack[-1].paragraph)
            if name in ENDS:
                ended, around = ENDS[name]
                if any(count[other] for other in ended):
                    depth, last = len(stack) - 1, 0
                    while depth and stack[depth].name not in around:
                        last = depth if stack[depth].name in ended else last
                        depth -= 1
                    if last:
                        leave(last)
            enter(name, _attributes(rest) if rest else {})
        elif rest and ("class" in rest or "id" in rest or "role" in rest or "style" in rest):
            # Inline elements matter only if they are no part of the article.
            attributes = _attributes(rest)
            if not stack[-1].chrome and _is_chrome(name, attributes, stack[-1]):
                end_line()
                enter(name, attributes)
    end_line()
    return lines
