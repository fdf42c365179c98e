"""Main text of web pages by line-block distribution.

Markup is stripped so that each block of a page is a line. Lines of menus,
headers, footers, sidebars, notices, adverts, forms and comments are left out.
An article element is kept whole. On pages without one the lengths of the other
lines are summed over a sliding window, in which lines that are mostly links
weigh nothing; text begins where the sums surge and ends where they dive. The
heaviest stretches tell which part of the page is the main text: all of the
container they stand in is kept from the first surge to the last line that
weighs, short blocks and links between text with it.

Results in odd cases: a null or empty page, or one without any text that
weighs, has the text ""; unclosed elements end with the page, but an unclosed
element that would be left out ends where the article or another such element
begins; scripts, styles and comments that are never closed hide the rest of the
page, other raw elements (svg, select, iframe and so on) without an end tag end
at their own tag. An element that holds most of the text stays whatever its name.
Repeated rows give repeated results; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from wayfare.llm.common import arrow_map, table

#: Lines of one window, and the sum over it at which text surges.
WINDOW = 3
SURGE = 80
#: Where the page has no article element: share of the heaviest stretch's weight from which another stretch counts as heavy.
STRETCH_SHARE = 0.2

# Elements by their role.
RAW = ("script", "style", "noscript", "template", "svg", "textarea", "select", "iframe", "canvas")
UNENDED_HIDES = ("script", "style")
NOT_NESTED = ("noscript", "textarea", "select", "iframe")
LEFT_OUT = ("nav", "footer", "aside", "form", "dialog", "menu", "button", "head")
ARTICLE = ("article", "main")
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "title", "tr", "ul"))
CONTAINERS = frozenset(("div", "section", "td", "center"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
# Words of a class or an id, as wholes: these, and the real compounds of some of them.
NAMES_LEFT_OUT = frozenset((
    "ad ads adv advert adverts advertisement advertisements banner sponsor sponsored promo cookie cookies consent notice popup "
    "modal newsletter subscribe signup login sidebar side-bar widget menu navbar nav-bar navigation breadcrumb breadcrumbs "
    "pagination pager toolbar masthead site-header page-header site-footer page-footer footer share sharing social related "
    "recommended "
    "adsbygoogle google-ad google-ads ad-banner banner-ad ad-block ad-box ad-break ad-container ad-label ad-slot ad-space ad-unit "
    "ad-wrapper ad-wrap ads-container ads-wrapper top-ad side-ad sidebar-ad advert-box advertisement-box promo-box promo-banner "
    "sponsored-content sponsored-links sponsored-post cookie-notice cookie-banner cookie-bar cookie-consent cookie-popup cookie-law "
    "cookie-message cookies-notice cookies-banner consent-banner consent-popup site-notice popup-overlay modal-dialog modal-content "
    "newsletter-signup newsletter-form newsletter-box subscribe-box subscribe-form signup-form login-form login-box "
    "left-sidebar right-sidebar sidebar-left sidebar-right sidebar-widget sidebar-menu widget-area main-menu nav-menu top-menu "
    "menu-bar main-navigation site-navigation post-navigation footer-links footer-menu footer-widgets "
    "share-buttons share-bar share-links share-button sharing-buttons social-share social-sharing social-links social-icons "
    "social-buttons related-posts related-articles related-stories related-links related-content related-news "
    "recommended-posts recommended-articles").split())
COMMENTS = frozenset((
    "comment comments disqus replies respond comment-list comment-form comments-area comments-list comments-section comment-section "
    "post-comments disqus-thread reply-form").split())
ROLES_LEFT_OUT = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"))
ROLES_UNSEEN = frozenset(("dialog", "alert"))
#: Characters from which an element that holds most of the text is kept whatever its name.
MOST_FROM = 200

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)>", re.S | re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_RAW_START = {name: re.compile(rf"<{name}(?=[\s/>])", re.I) for name in NOT_NESTED}
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-hidden|hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


def left_out(name: str, attributes: str, in_article: bool) -> str | None:
    """Whether an element's content may be none of the main text: "always", by its "tag", by its "name", or as "comments"."""
    if name in LEFT_OUT or (name == "header" and not in_article):
        return "always" if name in ("head", "dialog") else "name" if name == "form" else "tag"
    if not attributes or name in ("html", "body", *ARTICLE):
        return None
    why = None
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value.lower() in ROLES_UNSEEN):
            return "always"
        words = value.lower().replace("_", "-").split() if key in ("class", "id") else ()
        if not COMMENTS.isdisjoint(words):
            why = "comments"
        elif not why and (not NAMES_LEFT_OUT.isdisjoint(words) or (key == "role" and value.lower() in ROLES_LEFT_OUT)):
            why = "name"
    return why


class Doubtful:
    """Elements that may be left out, in the order they open; number 0 is none of them."""

    def __init__(self):
        self.above, self.why, self.inside, self.ended = [0], [""], [False], [True]
        self.open: list[int] = []

    @property
    def now(self) -> int:
        return self.open[-1] if self.open else 0

    def start(self, why: str, inside: bool) -> None:
        self.above.append(self.now)
        self.why.append(why)
        self.inside.append(inside)
        self.ended.append(False)
        self.open.append(len(self.why) - 1)

    def end(self) -> None:
        self.ended[self.open.pop()] = True

    def gone(self, found: list[Line]) -> list[bool]:
        """Whether each element is left out, given lines whose ``gone`` is the element they stand in.

        An element that holds most of the text of the page (or of its articles, if it stands in one) stays; one of
        comments does so only if there is no other text, one left out by its tag only if it was never closed.
        """
        size = [0] * len(self.why)
        total, rest = {True: 0, False: 0}, {True: 0, False: 0}
        for line in found:
            size[line.gone] += len(line.text)
            if self.why[line.gone] != "always":
                total[False] += len(line.text)
                total[True] += line.inside * len(line.text)
            if not line.gone:
                rest[False] += len(line.text)
                rest[True] += line.inside * len(line.text)
        out = [False] * len(size)
        for i in range(len(size) - 1, 0, -1):
            if self.why[i] != "always":
                size[self.above[i]] += size[i]
        for i in range(1, len(size)):
            where = self.inside[i]
            most = size[i] >= MOST_FROM and size[i] * 2 > total[where]
            stays = most and (
                self.why[i] == "name" or (self.why[i] == "tag" and not self.ended[i])
                or (self.why[i] == "comments" and rest[where] < MOST_FROM))
            out[i] = not stays or out[self.above[i]]
        return out


class Line(NamedTuple):
    """One block of a page; ``linked`` counts its characters in links, ``box`` is the container it stands in."""

    text: str
    gone: bool | int  # left out; until that is settled, the element that may be
    inside: bool  # an article
    linked: int
    box: int


class Boxes:
    """Containers of a page in the order they open; number 0 is the page itself."""

    def __init__(self):
        self.above, self.last = [0], [0]  # the container around each, and the last one inside it
        self._open: list[tuple[str, int]] = []
        self._names: Counter[str] = Counter()

    @property
    def now(self) -> int:
        return self._open[-1][1] if self._open else 0

    def open(self, name: str) -> None:
        self.above.append(self.now)
        self.last.append(len(self.last))
        self._open.append((name, len(self.last) - 1))
        self._names[name] += 1

    def close(self, name: str | None = None) -> None:
        """The innermost open one of that name and all inside it; without a name, all."""
        if name is not None and not self._names[name]:
            return
        while self._open:
            found, box = self._open.pop()
            self._names[found] -= 1
            self.last[box] = len(self.last) - 1
            if found == name:
                return
        self.last[0] = len(self.last) - 1

    def holds(self, outer: int, inner: int) -> bool:
        return outer <= inner <= self.last[outer]

    def around(self, boxes: list[int]) -> int:
        """The innermost container of all of ``boxes``."""
        at = boxes[0]
        for box in boxes:
            while not self.holds(at, box):
                at = self.above[at]
        return at

    def outermost(self, box: int) -> int:
        while box and self.above[box]:
            box = self.above[box]
        return box


def tokens(html: str) -> Iterator[tuple[int, int, re.Match]]:
    """(start, end, match) of comments, declarations and tags; a raw element is one token as far as its end tag."""
    at = 0
    ends: dict[str, tuple[int, int] | None] = {}
    while token := _TOKEN.search(html, at):
        at = token.end()
        name = (token["name"] or "").lower()
        if name in _RAW_END and not token["end"]:
            if name in ends and (ends[name] is None or ends[name][0] >= at):
                end = ends[name]
            else:
                found = _RAW_END[name].search(html, at)
                end = ends[name] = found and found.span()
            if name in UNENDED_HIDES:
                at = end[1] if end else len(html)
            elif end and not token["attributes"].endswith("/"):
                again = name in _RAW_START and _RAW_START[name].search(html, at, end[0])
                at = at if again else end[1]
        yield token.start(), at, token


def lines(html: str) -> tuple[list[Line], Boxes]:
    """The blocks of the page in page order, and the containers they stand in."""
    out: list[Line] = []
    boxes = Boxes()
    text: list[str] = []
    links = [0]
    open_names: list[tuple[str, str | None]] = []  # "out" (may be left out), "article", or only of such an element's name
    doubtful = Doubtful()
    articles = 0
    opened: Counter[str] = Counter()
    anchors = 0

    def put(piece: str) -> None:
        if piece:
            text.append(piece)
            if anchors:
                links[0] += len(piece.strip())

    def line() -> None:
        joined = " ".join(unescape("".join(text)).split())
        out.append(Line(joined, doubtful.now, articles > 0, links[0], boxes.now))
        text.clear()
        links[0] = 0

    at = 0
    for start, end, token in tokens(html):
        put(html[at:start])
        at = end
        name = (token["name"] or "").lower()
        if not name or name in _RAW_END:
            continue
        if name in BLOCKS or name in LEFT_OUT:
            line()
        elif name == "a":
            anchors = 0 if token["end"] else 1
        if name in CONTAINERS:
            if token["end"]:
                boxes.close(name)
            elif not token["attributes"].endswith("/"):
                boxes.open(name)
        if token["end"]:
            if opened[name]:
                if name not in BLOCKS:
                    line()
                last = None
                while last != name:
                    last, kind = open_names.pop()
                    opened[last] -= 1
                    if kind == "out":
                        doubtful.end()
                    elif kind == "article":
                        articles -= 1
        elif name not in VOID and not token["attributes"].endswith("/"):
            why = left_out(name, token["attributes"], articles > 0)
            kind = "out" if why else "article" if name in ARTICLE else None
            if kind == "article" and doubtful.open and not articles:
                # An article never stands inside a menu: what is open there was not closed.
                open_names = []
                while doubtful.open:
                    doubtful.end()
                opened.clear()
            if kind is not None or opened[name]:
                if kind is not None and name not in BLOCKS:
                    line()
                open_names.append((name, kind))
                opened[name] += 1
                if kind == "out":
                    doubtful.start(why, articles > 0)
                elif kind == "article":
                    articles += 1
    put(html[at:] if not re.match(r"<[a-zA-Z/!?]", html[at:]) else "")
    line()
    boxes.close()
    gone = doubtful.gone(out)
    return [found._replace(gone=gone[found.gone]) for found in out if found.text], boxes


def weights(found: list[Line]) -> np.ndarray:
    """Length of each line as the distribution counts it; lines that are mostly links weigh nothing."""
    return np.array([0 if line.linked * 2 > len(line.text) else len(line.text) for line in found], float)


def stretches(weight: np.ndarray) -> list[tuple[int, int]]:
    """(surge, dive) of each stretch: window sums reach SURGE (or half the page's highest) at its first line and are
    zero after its last."""
    if not len(weight):
        return []
    sums = np.convolve(weight, np.ones(WINDOW))[WINDOW - 1:]  # of each line and the lines after it
    surge = min(SURGE, sums.max() / 2)
    out, at = [], 0
    while at < len(weight):
        if sums[at] >= surge and weight[at] > 0:
            end = at
            while end < len(weight) and sums[end] > 0:
                end += 1
            out.append((at, end))
            at = end
        at += 1
    return out


def kept(found: list[Line], boxes: Boxes) -> list[Line]:
    """Lines of the outermost container below the body that holds the heavy stretches, from the first surge to the last line
    that weighs. A container of the heavy stretches alone is kept from its first line that weighs."""
    weight = weights(found)
    each = stretches(weight)
    if not each:
        return []
    total = [weight[a:b].sum() for a, b in each]
    heavy = [i for (a, b), t in zip(each, total) if t >= STRETCH_SHARE * max(total) for i in range(a, b) if weight[i]]
    inner = boxes.around([found[i].box for i in heavy])
    outer = boxes.outermost(inner)
    inside = [i for i, line in enumerate(found) if weight[i] and boxes.holds(outer, line.box)]
    first = next(a for a, _ in each if boxes.holds(outer, found[a].box))
    if inner:
        first = min(first, next(i for i in inside if boxes.holds(inner, found[i].box)))
    return [line for line in found[first:inside[-1] + 1] if boxes.holds(outer, line.box)]


def extract(html: str | None) -> str:
    """The main text of one page: its blocks in page order, joined by one blank."""
    if not html:
        return ""
    found, boxes = lines(html)
    found = [line for line in found if not line.gone]
    in_article = [line for line in found if line.inside]
    return " ".join(line.text for line in in_article or kept(found, boxes))


def read(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""

    def run(ids, urls, bodies):
        texts = [extract(b) for b in bodies]
        return {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}

    return arrow_map(pages.select("page_id", "url", "html"), run, {
        "page_id": "long", "url": "string", "text": "string", "n_chars": "long"}, rows=64)


def op3_main_text(spark, sf_dir: str) -> DataFrame:
    return read(table(spark, sf_dir, "pages"))
