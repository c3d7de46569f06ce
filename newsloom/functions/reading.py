"""Captured pages read once: a fold over their pieces builds the element tree, from which all texts come.

Tags, attributes and texts are read like HTML5 says where it matters for text: a quoted value may hold anything,
an attribute counts by its whole name, start tags end open paragraphs, items and cells, an element left open ends with its
parent or the page, a stray end tag is a line break if it names a block, references count by their longest name with or without
a semicolon (in attributes only whole ones). `read_page` runs in Arrow batches; line cleaning stays a column expression.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose boundaries end a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main nav ol p pre section table td th title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
OF_HEAD = frozenset("base link meta noscript script style template title".split())
#: What a start tag ends if it is the innermost open element of its kind, up to the element that scopes it.
ENDED_BY = {
    **{n: ("li",) for n in ("li",)}, **{n: ("dt", "dd") for n in ("dt", "dd")}, "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    **{n: ("option",) for n in ("option", "optgroup")}, **{n: ("tr", "td", "th", "thead", "tbody") for n in ("thead", "tbody", "tfoot")},
}
SCOPES = frozenset("ul ol dl table select article section div main body html".split())
ENDS_PARAGRAPH = (BLOCKS | frozenset("details dialog dir fieldset hgroup menu search summary tbody tfoot thead".split())) - frozenset(("br", "title", "head", "td", "th"))

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)|[^<]+|<""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
REFERENCE = re.compile(r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|[A-Za-z][A-Za-z0-9]*;?=?)")

# Words of classes and ids, and what they and elements count in the search for the text.
UNLIKELY = frozenset("ad ads advert advertisement banner breadcrumbs comment comments cookie footer menu nav newsletter pager popup promo related share sidebar social sponsor subscribe widget".split())
LIKELY = frozenset("article body content entry main post story text".split())
ELEMENT_SCORE = {"article": 8, "main": 8, "section": 3, "div": 3, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "form": -3, "address": -3, "body": 0}
NAME_SCORE = 25
PARAGRAPHS = frozenset("p pre blockquote td".split())
#: Siblings are joined from this score, or this share of the best one's, on.
JOINED, JOINED_SHARE = 10.0, 0.2
NO_ARTICLE_TEXT = frozenset("script style table aside nav".split())
NO_TEXT = frozenset("script style aside nav".split())
NOT_READ = NO_TEXT | {"footer", "form"}


def text_of(raw: str) -> str:
    """Text with its references decoded, each once; a no-break space by reference is a blank."""
    if "&" not in raw:
        return raw
    return "\xa0".join(unescape(part).replace("\xa0", " ") for part in raw.split("\xa0"))


def value_of(raw: str) -> str:
    """An attribute's value; references without a semicolon count only if neither a letter, a digit nor "=" follows."""

    def decoded(m: re.Match) -> str:
        ref = m[0]
        if ref[1] == "#" or ref[1:] in html5 and not ref.endswith("="):
            return unescape(ref)
        return ref

    return REFERENCE.sub(decoded, raw) if "&" in raw else raw


def attributes(tag: str) -> dict[str, str]:
    """Values by lower-case name, the first of repeated ones."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), value_of(m[2] or m[3] or m[4] or ""))
    return found


class Page:
    """The tree of a page as events in page order: a node's number where it begins, ~number where it ends, text, None for a break."""

    def __init__(self, html: str) -> None:
        self.names, self.parents, self.begins, self.ends, self.marks = ["html"], [-1], [0], [0], [frozenset()]
        self.events: list = [0]
        self.canonical: str | None = None
        self.og_url: str | None = None
        self._read(html)

    def _open(self, stack: list[int], name: str, tag: str) -> None:
        words = frozenset()
        if "class" in tag or "id" in tag or "CLASS" in tag or "ID" in tag:
            own = attributes(tag)
            words = frozenset(re.split(r"[^a-z]+", f"{own.get('class', '')} {own.get('id', '')}".lower()))
        self.names.append(name)
        self.parents.append(stack[-1])
        self.marks.append(words)
        self.begins.append(len(self.events))
        self.ends.append(-1)
        self.events.append(len(self.names) - 1)
        stack.append(len(self.names) - 1)
        self.open_names[name] += 1

    def _close(self, stack: list[int], depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            self.ends[node] = len(self.events)
            self.events.append(~node)
            self.open_names[self.names[node]] -= 1

    def _read(self, html: str) -> None:
        names, stack, at, size = self.names, [0], 0, len(html)
        self.open_names: Counter[str] = Counter()

        def innermost(wanted: tuple[str, ...], scopes: frozenset = frozenset()) -> int:
            """The place in the stack of the innermost open element of these names, before a scope ends the search; 0 if none."""
            if not any(self.open_names[w] for w in wanted):
                return 0
            for place in range(len(stack) - 1, 0, -1):
                if names[stack[place]] in wanted:
                    return place
                if names[stack[place]] in scopes:
                    return 0
            return 0

        while at < size:
            m = TOKEN.match(html, at)
            at = m.end()
            if m[2] is None:
                if m[0][0] != "<" or len(m[0]) == 1:
                    self.events.append(text_of(m[0]))
                continue
            name, tag = m[2].lower(), m[3]
            if m[1]:
                place = innermost((name,), frozenset(("td", "th")) if name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th") else frozenset(("table",)))
                if place:
                    self._close(stack, place)
                elif name in BLOCKS:
                    self.events.append(None)
                continue
            if name not in OF_HEAD and name not in ("html", "head") and names[stack[-1]] == "head":
                self._close(stack, len(stack) - 1)
            if name in ENDS_PARAGRAPH and (place := innermost(("p",), frozenset(("table", "button", "td", "th")))):
                self._close(stack, place)
            if name in ENDED_BY:
                while place := innermost(ENDED_BY[name], SCOPES):
                    self._close(stack, place)
            if name == "link" and self.canonical is None:
                own = attributes(tag)
                if "canonical" in own.get("rel", "").lower():
                    self.canonical = own.get("href", "")
            elif name == "meta" and self.og_url is None:
                own = attributes(tag)
                if own.get("property", "") == "og:url":
                    self.og_url = own.get("content", "")
            if name == "html":
                continue
            self._open(stack, name, tag)
            if name in VOID:
                self._close(stack, len(stack) - 1)
            elif name in RAW:
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
                if name in ("textarea", "title"):
                    self.events.append(text_of(html[at : end.start() if end else size]))
                at = end.end() if end else size
                self._close(stack, len(stack) - 1)
        self._close(stack, 1)
        self.ends[0] = len(self.events)

    def text(self, node: int, left_out: frozenset, by_name: bool = False) -> str:
        """The text inside a node, without elements of some names (and, `by_name`, those that their class or id makes unlikely)."""
        events, names, out, at = self.events, self.names, [], self.begins[node] + 1
        while at < self.ends[node]:
            e = events[at]
            at += 1
            if e is None:
                out.append("\n")
            elif isinstance(e, str):
                out.append(e)
            else:
                own = e if e >= 0 else ~e
                if e >= 0 and (names[own] in left_out or by_name and self.unlikely(own)):
                    at = self.ends[own] + 1
                if names[own] in BLOCKS:
                    out.append("\n")
        return "".join(out)

    def first(self, name: str) -> int | None:
        return next((i for i, n in enumerate(self.names) if n == name), None)

    def unlikely(self, node: int) -> bool:
        return not UNLIKELY.isdisjoint(self.marks[node]) and LIKELY.isdisjoint(self.marks[node]) and self.names[node] not in ("article", "main", "body", "html")

    def address(self) -> str | None:
        return self.canonical or self.og_url or ""

    def main(self) -> str:
        """The text of the first article, else of the first main element."""
        for name in ("article", "main"):
            node = self.first(name)
            if node is not None and (found := self.text(node, NO_ARTICLE_TEXT)).strip():
                return found
        return ""

    def _lengths(self) -> tuple[list[int], list[int], list[int], list[bool]]:
        """(letters before each event, letters of links, commas; whether a node is left out with all inside of it)."""
        total, linked, commas, hidden = [0], [0], [0], [False] * len(self.names)
        links = skipped = 0
        for e in self.events:
            n = c = 0
            if isinstance(e, str):
                if not skipped:
                    n, c = len(" ".join(e.split())), e.count(",")
            elif e is not None:
                own, step = (e, 1) if e >= 0 else (~e, -1)
                if self.names[own] in NOT_READ or self.unlikely(own):
                    skipped += step
                    hidden[own] = True
                hidden[own] = hidden[own] or skipped > 0
                links += step * (self.names[own] == "a")
            total.append(total[-1] + n)
            linked.append(linked[-1] + (n if links else 0))
            commas.append(commas[-1] + c)
        return total, linked, commas, hidden

    def readable(self) -> str:
        """The text around the paragraphs that count most: each adds to its parent, and half of that to the one above.

        Without a paragraph it is the text of the body, which need not be marked.
        """
        total, linked, commas, hidden = self._lengths()
        inside = lambda sums, node: sums[self.ends[node]] - sums[self.begins[node]]
        score: dict[int, float] = {}

        def add(node: int, points: float) -> None:
            if node >= 0 and not hidden[node]:
                if node not in score:
                    named = NAME_SCORE * (not LIKELY.isdisjoint(self.marks[node])) - NAME_SCORE * (not UNLIKELY.isdisjoint(self.marks[node]))
                    score[node] = ELEMENT_SCORE.get(self.names[node], 0) + named
                score[node] += points

        for node, name in enumerate(self.names):
            if name in PARAGRAPHS and not hidden[node] and (n := inside(total, node)):
                points = 1 + inside(commas, node) + min(n // 100, 3)
                add(self.parents[node], points)
                add(self.parents[self.parents[node]], points / 2)
        density = lambda node: inside(linked, node) / max(1, inside(total, node))
        if not score:
            return self.text(self.first("body") or 0, NO_TEXT | {"head", "title"})
        held = {node: s * (1 - density(node)) for node, s in score.items()}
        best = max(held, key=lambda node: (held[node], -node))
        enough = max(JOINED, JOINED_SHARE * held[best])
        if self.parents[best] < 0:
            return self.text(best, NOT_READ, True)
        parts = []
        for node in range(1, len(self.names)):
            if self.parents[node] != self.parents[best] or hidden[node]:
                continue
            joins = node == best or held.get(node, 0.0) >= enough
            if not joins and self.names[node] == "p":
                n, d = inside(total, node), density(node)
                joins = n > 80 and d < 0.25 or 0 < n <= 80 and d == 0 and self.text(node, NOT_READ).rstrip().endswith((".", "!", "?"))
            if joins:
                parts.append(self.text(node, NOT_READ, True))
        return "\n".join(parts)

    def whole(self) -> str:
        return self.text(0, frozenset(("script", "style")))


PARTS = {"address": Page.address, "main": Page.main, "readable": Page.readable, "whole": Page.whole}


def read_page(html: Column, *parts: str) -> Column:
    """Struct of the parts of a page (of `PARTS`), as they stand; all null without a page."""

    @F.arrow_udf(", ".join(f"{p} string" for p in parts))
    def read(pages: pa.Array) -> pa.Array:
        rows = []
        for html in pages.to_pylist():
            page = None if html is None else Page(html)
            rows.append(None if page is None else {p: PARTS[p](page) for p in parts})
        return pa.array(rows, pa.struct([(p, pa.string()) for p in parts]))

    return read(html)
