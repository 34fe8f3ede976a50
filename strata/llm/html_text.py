"""Main text of web pages by text-to-tag ratios (operator 2).

The standard library's parser streams start, end and text events. They are cut
into lines at block tags; a line's text-to-tag ratio is its characters over its
tags, on a log scale. Ratios are smoothed with a Gaussian over neighbouring lines and
clustered into two by an iterated threshold; lines that reach it, smoothed or
by themselves, are content.

The region is the innermost element that holds four fifths of the content's mass
(characters times smoothed ratio): an ``article`` or ``main``, or else an element
that groups at least two lines and holds every ``article`` with content. The
region is taken whole, short lines too. Where no element stands out, it is the
page from its first to its last content line, with headings, and lines of the
same kind of block that are not links, before and behind.

Elements that are boilerplate by tag, role or attribute never give lines. A class
or id names boilerplate where all parts of a token are words for it or for a
place in a layout (``top-menu``, ``ad-box``, not ``related-work`` or ``ads-data``),
without a modifier (``with-sidebar``, ``comments-open``). Such elements are kept
out of the clustering and give no lines, but for: one that holds a ``main``, an
outermost ``article`` or most of the page's text (comments alone stay out at any
length where an ``article`` or ``main`` has running text outside them); inside
the region, notices and related parts with a line of three quarters of the threshold, and menus that are
not links. Where nothing else is left, no class or id counts.

Defined results: NULL or empty html, or a page without text outside elements
hidden by tag, role or attribute, gives the empty text. Where no line stands out, all lines are the
region. Unclosed, crossed and unknown tags are taken as they come; character
references are decoded; a block's white space becomes one space.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names by role.
_SKIPPED = frozenset("script style noscript template head title nav footer aside form button select "
                     "textarea iframe svg canvas object dialog menu audio video map math".split())
_BLOCKS = frozenset("html body p div article main section header h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
                    "table thead tbody tfoot tr td th caption blockquote pre figure figcaption hr "
                    "address details summary fieldset legend center hgroup".split()) | _SKIPPED
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_WHOLE = frozenset(("article", "main"))
_NEVER_HINTED = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
_COMMENTS = re.compile(r"comments?|commentlist|respond|disqus", re.I)
_MENUS = re.compile(r"menu\w*|nav|navbar|navigation|breadcrumbs?", re.I)
_ASIDES = re.compile(r"notices?|alert|related|recommend\w*", re.I)
_HINTS = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|sidebar\w*|"
    r"share|sharing|social|newsletter|subscribe|popup|modal|overlay|footer|"
    r"masthead|pagination|pager|login|signup|widget|skip|"
    + "|".join(x.pattern for x in (_MENUS, _ASIDES, _COMMENTS)), re.I)
_STRONG = re.compile(f"(?!(?:{_MENUS.pattern}|{_ASIDES.pattern})$)(?:{_HINTS.pattern})", re.I)
#: Parts of a class that say what a layout has or lacks, not what the element is.
_MODIFIERS = frozenset("with without no has have open closed enabled disabled".split())
#: Parts of a class that say where something is, beside a word that says what it is.
_PLACES = frozenset("top bottom left right main site page post article inner outer side first last global mobile "
                    "box wrap wrapper container block area section list item items link links bar panel unit "
                    "slot group col column row holder zone region header head title text content body primary "
                    "secondary sub mini small large js in on at of the and bootstrap policy form thread".split())
#: Elements that group blocks; others are blocks of text themselves.
_GROUPS = frozenset("html body div main article section td center details".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())


def hinted(named: str, words: re.Pattern) -> bool:
    """Whether a token of a class or id (between white space) is one of ``words``,
    alone or with other hints, places and numbers."""
    for token in named.split():
        parts = [x for x in re.split("[_-]", token.lower()) if x]
        if (any(map(words.fullmatch, parts)) and not _MODIFIERS.intersection(parts)
                and all(x in _PLACES or x.isdigit() or _HINTS.fullmatch(x) for x in parts)):
            return True
    return False


class Lines(HTMLParser):
    """Streams events into lines: (text, tags, ids of the open elements, is a heading, share in links).

    Elements whose class or id names boilerplate are numbered as they start (``hint_of``)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Of each such element: characters, articles, mains inside, and what names it.
        self.hints: list[tuple[int, int, int, str]] = []
        self.hint_of: dict[int, int] = {}
        self.fixed = 0                                     # open elements hidden by tag, role or attribute
        self.under = 0                                     # open elements with a hint
        self.characters = self.articles = self.mains = 0   # outside hidden ones
        self.running = 0                                   # characters of articles and mains under no hint
        self.lines: list[tuple[str, int, tuple[int, ...], bool, float]] = []
        self.tag_of: list[str] = []                        # element id -> tag
        self.open: list[tuple[str, int, bool, int]] = []   # tag, id, starts boilerplate, hint or -1
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.in_link = self.heading = False

    def cut(self):
        if self.text:
            plain = " ".join("".join(self.text).split())
            if plain:
                self.lines.append((plain, self.tags, tuple(e[1] for e in self.open), self.heading,
                                   self.linked / len(plain)))
                self.tags = 0
            self.text, self.linked = [], 0

    def boilerplate(self, tag, attrs) -> tuple[bool, bool]:
        """Whether an element is boilerplate by tag, role or attribute, and by a hint."""
        if tag in _SKIPPED:
            return True, False
        if tag == "header":
            return not any(e[0] in _WHOLE for e in self.open), False
        if not attrs or tag in _NEVER_HINTED:
            return False, False
        a = dict(attrs)
        named = f"{a.get('class') or ''} {a.get('id') or ''}"
        if tag == "article":
            return False, hinted(named, _COMMENTS)
        fixed = ("hidden" in a or a.get("aria-hidden") == "true" or (a.get("role") or "") in _ROLES
                 or "display:none" in (a.get("style") or "").replace(" ", "").lower())
        return fixed, not fixed and hinted(named, _HINTS)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        block = tag in _BLOCKS
        if block:
            self.cut()
            if self.open and self.open[-1][0] == tag and tag in ("p", "li", "td", "th", "tr", "dt", "dd"):
                self.leave()                               # its end tag is implied
            elif self.open and self.open[-1][0] == "p":
                self.leave()
            self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif tag == "br":
            self.text.append(" ")
        if tag in _VOID:
            return
        fixed, hint = self.boilerplate(tag, attrs)
        number = -1
        if hint:
            number = len(self.hints)
            a = dict(attrs)
            self.hints.append((-self.characters, -self.articles, -self.mains,
                               f"{a.get('class') or ''} {a.get('id') or ''}"))
        elif tag in _WHOLE and not self.fixed:
            self.mains += tag == "main"
            self.articles += tag == "article" and not any(e[0] == "article" for e in self.open)
        self.in_link = self.in_link or tag == "a"
        if block or fixed or hint:
            if hint:
                self.hint_of[len(self.tag_of)] = number
            self.open.append((tag, len(self.tag_of), fixed, number))
            self.tag_of.append(tag)
            self.fixed += fixed
            self.under += hint

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag in _BLOCKS:
            self.cut()
        elif tag == "br":
            self.text.append(" ")

    def leave(self):
        _, _, fixed, number = self.open.pop()
        self.fixed -= fixed
        if number >= 0:                                    # from counts at the start to those inside
            self.under -= 1
            characters, articles, mains, named = self.hints[number]
            self.hints[number] = (characters + self.characters, articles + self.articles,
                                  mains + self.mains, named)

    def handle_endtag(self, tag):
        self.tags += 1
        self.in_link = self.in_link and tag != "a"
        if tag in _BLOCKS:
            self.cut()
            self.heading = False
        if any(e[0] == tag for e in reversed(self.open)):
            self.cut()
            while self.open[-1][0] != tag:
                self.leave()
            self.leave()

    def handle_data(self, data):
        if not self.fixed:
            n = len("".join(data.split()))
            self.characters += n
            self.linked += n * self.in_link
            self.text.append(data)
            if not self.under and not self.heading and any(e[0] in _WHOLE for e in self.open):
                self.running += n

    def boilerplate_elements(self) -> dict[int, str]:
        """Elements that a class or id names as boilerplate, but those that hold what none may hide."""
        out = {}
        for element, number in self.hint_of.items():
            characters, articles, mains, named = self.hints[number]
            holds = articles or 2 * characters > self.characters
            if not mains and (not holds or hinted(named, _COMMENTS) and self.running):
                out[element] = named
        return out

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)                    # any <![...> counts as a comment
        return end + 1 if end >= 0 else len(self.rawdata)


def parsed(html: str) -> Lines:
    p = Lines()
    p.feed(html)
    p.close()
    p.cut()
    while p.open:
        p.leave()
    return p


def smooth(ratios: list[float], radius: int = 2) -> list[float]:
    """Gaussian mean over ``radius`` lines each side, sigma of the same width."""
    kernel = [math.exp(-0.5 * (d / radius) ** 2) for d in range(-radius, radius + 1)]
    out = []
    for k in range(len(ratios)):
        total = weight = 0.0
        for d, w in enumerate(kernel, k - radius):
            if 0 <= d < len(ratios):
                total += w * ratios[d]
                weight += w
        out.append(total / weight)
    return out


def threshold(values: list[float], rounds: int = 20) -> float:
    """Midpoint of two clusters, iterated until it rests (one-dimensional 2-means)."""
    cut = sum(values) / len(values)
    for _ in range(rounds):
        low = [v for v in values if v < cut]
        high = [v for v in values if v >= cut]
        if not low or not high:
            break
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def region_of(lines: list[tuple], mass: list[float], tag_of: list[str]) -> int | None:
    """The element that is the region; None: the page."""
    held: dict[int, float] = {}
    size: dict[int, int] = {}
    articles: dict[int, int] = {}                          # content lines of articles and mains
    parts = 0
    for line, m in zip(lines, mass):
        inside = m > 0 and any(tag_of[e] in _WHOLE for e in line[2])
        parts += inside
        for e in line[2]:
            held[e] = held.get(e, 0.0) + m
            size[e] = size.get(e, 0) + 1
            articles[e] = articles.get(e, 0) + inside
    # Elements with four fifths of the mass lie in each other: the last is the innermost.
    most = [e for e, m in held.items() if 5 * m >= 4 * sum(mass) * (1 - 1e-9)]
    whole = [e for e in most if tag_of[e] in _WHOLE]
    groups = [e for e in most if tag_of[e] in _GROUPS and size[e] > 1 and articles[e] == parts]
    found = max(whole or groups, default=None)
    return None if found is None or tag_of[found] in ("html", "body") else found


def main_text(html) -> str:
    if not isinstance(html, str) or not html:
        return ""
    p = parsed(html)
    boilerplate = p.boilerplate_elements()
    free = [line for line in p.lines if not boilerplate.keys() & set(line[2])]
    if not free:
        boilerplate, free = {}, p.lines
    if not free:
        return ""
    own = [math.log1p(len(text) / max(1, tags)) for text, tags, *_ in free]
    ratios = smooth(own)
    cut = threshold(ratios)
    content = [max(r, o) >= cut for r, o in zip(ratios, own)]
    mass = [len(line[0]) * r if good else 0.0 for line, r, good in zip(free, ratios, content)]
    region = region_of(free, mass, p.tag_of)
    if region is None:
        block = lambda line: p.tag_of[line[2][-1]] if line[2] else ""
        kinds = {block(line) for line, good in zip(free, content) if good}
        first = content.index(True)
        last = len(content) - 1 - content[::-1].index(True)
        like = [line[3] or block(line) in kinds and line[4] < 0.5 for line in free]
        while first > 0 and like[first - 1]:
            first -= 1
        while last + 1 < len(free) and like[last + 1] and not free[last + 1][3]:
            last += 1
        return "\n".join(line[0] for line in free[first:last + 1])
    # Inside the region, what a class calls a notice or a menu is judged by its lines.
    linked: dict[int, list[float]] = {}
    stands_out: set[int] = set()
    for text, tags, path, _, links in p.lines:
        for e in boilerplate.keys() & set(path):
            linked.setdefault(e, []).append(links)
            if 4 * math.log1p(len(text) / max(1, tags)) >= 3 * cut:       # by itself, tags around it included
                stands_out.add(e)
    kept = {e for e, named in boilerplate.items() if e in linked and not hinted(named, _STRONG) and (
        e in stands_out if hinted(named, _ASIDES) else sum(linked[e]) < 0.5 * len(linked[e]))}
    return "\n".join(line[0] for line in p.lines
                     if region in line[2] and all(e in kept for e in boilerplate.keys() & set(line[2])))


@F.pandas_udf(T.StringType())
def _main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(h) for h in pages], dtype=object)


def main_text_column(html: str | Column) -> Column:
    return _main_text(F.col(html) if isinstance(html, str) else html)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    return pages.select("page_id", "url", main_text_column("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
