"""Main text of web pages by composite text density.

A page is read into a tree, forgiving unclosed and misplaced tags. Parts that say what they are (menus,
footers, forms, adverts, comments and the like, by element or by class) are left out. For every
other node, density is characters per tag, adjusted for links:

    C / T * log(C / LC * T / LT) to the base of e - 1 + log(C / NC * LC + LB / CB * C + e)

with C characters, T tags, LC characters and LT tags of links, NC characters outside links, LB and CB
link characters and characters of the body, zero divisors taken as 1. The base is e or more, so that
it is defined where a page has no link.

Tags of running text other than links (bold, line breaks and the like) are not counted, and what a node says
itself is a child of its own. The subtree with the largest sum of its children's densities is the core of the
article; of equal sums, the outermost. The least density on its path to the body is the threshold: the selection
grows over each ancestor with another part as dense as that, up to the outermost article by name that holds
the core. No element is taken for its name.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa

from tickloom.llm.common import on_texts

#: Fixed values of HTML: elements without content, with raw text, and of running text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr output q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that stand in a line of text, and end no word: shown in it, or not shown at all.
IN_LINE = frozenset(
    "area audio button canvas embed iframe img input label link meta meter noscript object picture progress script "
    "select source style svg template track video".split()
)
#: Elements that are no structure: they do not count as tags.
RUNNING = INLINE - {"a"} | VOID
#: A start tag of the key ends an open element of the value.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPE = frozenset("html body table ul ol dl button object article section main td th select".split())

#: Elements and words of classes, ids and roles that are no part of an article.
APART = frozenset(
    "head script style noscript template nav aside footer form button input select textarea iframe object "
    "embed svg canvas audio video dialog menu title".split()
)
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline "
    "comment comments commentlist consent contentinfo cookie cookies copyright disqus footer gdpr hidden masthead "
    "menu menubar modal nav navbar navigation newsletter notice notices notification overlay pagination "
    "pager popup promo promoted promotion recommended related replies respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split()
)
#: A class or id of these words only, with "header", is the header of the page.
PAGE_HEADER = frozenset("header site page top global main wrapper container".split())
WHOLE = frozenset("html body main article".split())
ARTICLES = frozenset(("article", "main"))

TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]+)))?")
WORD = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _apart(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element says that it is no part of the article."""
    if tag in APART or tag == "header" and not inside_article:
        return True
    if not attributes.strip():
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and HIDDEN.search(value):
            return True
        if name in ("class", "id", "role") and tag not in WHOLE:
            parted = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            words = {*WORD.findall(value.lower()), *WORD.findall(parted.lower())}
            if words & APART_WORDS or not inside_article and "header" in words <= PAGE_HEADER:
                return True
    return False


class Page:
    """The tree of a page in document order: node 0 is the root, a subtree is a range of nodes."""

    def __init__(self, html: str) -> None:
        self.tags, self.parents, self.apart, self.ends = [""], [-1], [False], [0]
        #: (node, text) in order; a text of None parts blocks.
        self.texts: list[tuple[int, str | None]] = []
        self.open = [0]
        #: How many elements of each name are open, so that a deep page is not searched in vain.
        self.counts: Counter[str] = Counter()
        self._read(html)
        while self.open:
            self._close()

    def _close(self) -> None:
        node = self.open.pop()
        self.ends[node] = len(self.tags)
        self.counts[self.tags[node]] -= 1

    def _close_first(self, tags: set[str], stop: frozenset[str]) -> None:
        """Close the innermost open element of these, and what is in it, unless one of `stop` is between."""
        if not any(self.counts[tag] > 0 for tag in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in tags:
                while len(self.open) > depth:
                    self._close()
                return
            if tag in stop:
                return

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            mark = html.find("<", at)
            if mark < 0:
                mark = size
            if mark > at:
                self.texts.append((self.open[-1], html[at:mark]))
            if mark == size:
                return
            m = TOKEN.match(html, mark) or BROKEN.match(html, mark)
            if not m:
                # A tag that never ends is cut off with the page; any other "<" is text.
                if html[mark + 1 : mark + 2].isalpha() or html[mark + 1 : mark + 2] == "/":
                    return
                self.texts.append((self.open[-1], "<"))
                at = mark + 1
                continue
            at = m.end()
            if m.lastindex is None or m[2] is None:
                continue
            tag = m[2].lower()
            if tag not in INLINE and tag not in IN_LINE and self.counts["svg"] <= 0:
                self.texts.append((self.open[-1], None))
            if m[1]:
                self._close_first({tag}, frozenset())
                continue
            if tag in ENDS:
                self._close_first(ENDS[tag], SCOPE - ENDS[tag])
            elif tag not in INLINE and tag not in VOID and tag not in IN_LINE:
                self._close_first({"p"}, SCOPE)
            node, parent = len(self.tags), self.open[-1]
            inside = any(self.counts[name] > 0 for name in ARTICLES)
            self.tags.append(tag)
            self.parents.append(parent)
            self.apart.append(self.apart[parent] or _apart(tag, m[3], inside))
            self.ends.append(node + 1)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else size
            if tag not in VOID:
                self.open.append(node)
                self.counts[tag] += 1

    def core(self) -> int:
        """The node whose text is the article."""
        n = len(self.tags)
        chars, tags = [0] * n, [0] * n
        link_chars, link_tags = [0] * n, [0] * n
        for node, text in self.texts:
            if text and not self.apart[node]:
                chars[node] += len(" ".join(unescape(text).split()))
        own = chars.copy()
        for node in range(n - 1, 0, -1):
            if self.apart[node]:
                continue
            up = self.parents[node]
            if self.tags[node] == "a":
                link_chars[node] = chars[node]
            chars[up] += chars[node]
            tags[up] += tags[node] + (self.tags[node] not in RUNNING)
            link_chars[up] += link_chars[node]
            link_tags[up] += link_tags[node] + (self.tags[node] == "a")
        body = next((i for i in range(n) if self.tags[i] == "body" and not self.apart[i]), 0)
        ratio = link_chars[body] / max(1, chars[body])

        def dense(c: int, t: int, lc: int, lt: int) -> float:
            base = e - 1 + log(c / max(1, c - lc) * lc + ratio * c + e)
            return c / max(1, t) * log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / log(base)

        density, sums = [0.0] * n, [0.0] * n
        for node in range(n - 1, -1, -1):
            if self.apart[node]:
                continue
            if chars[node]:
                density[node] = dense(chars[node], tags[node], link_chars[node], link_tags[node])
            if own[node] and self.tags[node] != "a":
                sums[node] += dense(own[node], 1, 0, 0)
            if node:
                sums[self.parents[node]] += density[node]
        best = body
        for node in range(body, self.ends[body]):
            if not self.apart[node] and sums[node] > sums[best]:
                best = node
        path = [best]
        while path[-1] != body and path[-1]:
            path.append(self.parents[path[-1]])
        threshold = min(density[node] for node in path)
        # What an author names an article ends there: a bound, which takes nothing in by itself.
        named = [depth for depth, node in enumerate(path) if self.tags[node] in ARTICLES]
        within = path[: named[-1] + 1] if named else path
        chosen = best
        for below, node in zip(within, within[1:]):
            other = node + 1
            while other < self.ends[node]:
                if other != below and density[other] >= threshold and not self.apart[other] and chars[other]:
                    chosen = node
                other = self.ends[other]
        return chosen

    def text(self, core: int) -> str:
        end, pieces = self.ends[core], []
        for node, text in self.texts:
            if text is None:
                pieces.append(" ")
            elif core <= node < end and not self.apart[node]:
                pieces.append(unescape(text))
        return " ".join("".join(pieces).split())


def main_text(html: str | None) -> str:
    """The article of a page. Null and empty pages, and pages without text, give an empty string."""
    if not html:
        return ""
    page = Page(html)
    return page.text(page.core())


extracted = on_texts(
    lambda pages: pa.array([main_text(p.decode()) if p else "" for p in pages], type=pa.string()), pa.string()
)
