"""Main text of web pages by maximum-scoring subsequence (operator 1).

A page is a sequence of words, which score above zero, and tags, which score below. The best contiguous
region, found by one linear scan, holds the article; the blocks it touches are its text. Scores are
log-odds of the kind of word or tag inside and outside of articles, counted on labelled pages: pages
whose own markup names exactly one article (`article` or `main`) label themselves, and a fixed count of hand-labelled
kinds stands in where there are none. Tags inside of an article element weigh `IN_ARTICLE` of what they weigh elsewhere;
the region alone decides, whatever elements it crosses.

Menus and scripts are left out by element or role, hidden elements by attribute; their words take no part in
the scan. A form, and any other element whose class or id names boilerplate (adverts, comments ...), is one thing that
scores below zero in the scan of what is around it, and is left out, unless its own best region, divided by `OVERRULED` (also
for names inside of it, but not for forms) and less the score of its name, beats that of its surroundings without it: then it
is read like any other. So a search or login form goes, and a form around the whole page does not. `article` and `main` are
never left out by their class or id. On pages without an article element the tags of lists weigh as they do inside of one.

Character references are decoded; white space (and `br`) inside a block becomes one space; blocks are joined by
one line feed in page order. Inline tags join text without a space.

Cases: null or empty html, and pages without words, give an empty text; a quote that never ends is no quote; unclosed
comments, scripts, styles, text areas and titles end with the page, other unclosed elements with their parent or the
page; `svg`, `math` and inline elements that close themselves are empty; of equally good regions the longest of those that start
first counts; repeated rows are extracted alike; a page of any length is read whole, in time that grows with its length; an empty
table gives no rows; extra columns stay, those of the outputs' names are replaced. At most `MAX_PAGES` pages are learned
from, chosen by a hash of the page id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.registry import query, table

MAX_PAGES = 4000

# Elements of HTML by how they are read.
RAW = frozenset("script style textarea title".split())
UNREAD = frozenset("template noscript iframe object svg math canvas audio video select noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
DROPPED = frozenset("nav footer aside button head dialog menu label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
FORMS = frozenset("form fieldset".split())
LISTS = frozenset("ul ol li dl dt dd".split())
# Words of classes and ids that name what is no article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion banner "
    "nav navbar navigation menu menus breadcrumb breadcrumbs topbar masthead toolbar pagination pager "
    "sidebar side sidenav aside widget widgets footer footnav colophon "
    "comment comments commentlist reply replies respond disqus discussion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "share sharing social related recommended recommendations trending hidden "
    "copyright disclaimer".split()
)
HOLDS = frozenset(("article", "main"))
KINDS = sorted(BLOCKS | VOID | RAW | UNREAD | {"a", "b", "i", "em", "strong", "span", "u", "small", "sup", "sub", "code", "font", "img", "label", "button"})
# Counts (inside, outside) of hand-labelled kinds, used beside those of the pages.
PRIOR = {"word": (900, 120), "link word": (20, 160), "p": (40, 4), "b": (6, 2), "i": (6, 2), "em": (6, 1), "strong": (6, 2), "h1": (4, 1), "h2": (4, 2), "br": (6, 3), "a": (8, 60), "li": (6, 60), "ul": (2, 16), "div": (4, 60), "span": (4, 30), "article": (0, 8), "main": (0, 8), "footer": (0, 8), "nav": (0, 8), "header": (0, 8), "named": (2, 20)}
LEAST = 0.05
#: A name divides what its element scores by so much before it is held against what is best around it.
OVERRULED = 2.0
#: The share of its score that a tag has inside of an article element, and one of LISTS on a page without one.
IN_ARTICLE = 0.25

#: One attribute: its whole name and, behind an equals sign, its value. A quote that never ends is no quote; it is looked
#: for once a page, as only the last one of its kind can be so.
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++)?+)?+""")
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+)*+)(?:>|\Z)|[^<]+|<""",
    re.S,
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def attributes_of(tag: str) -> tuple[dict[str, str], bool]:
    """Values by lower-case name, the first of repeated names, and whether the tag closes itself."""
    found, end = {}, 0
    for m in ATTRIBUTE.finditer(tag):
        value, end = m[2] or "", m.end()
        quoted = len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]
        found.setdefault(m[1].lower(), unescape(value[1:-1] if quoted else value).lower())
    return found, tag.endswith("/") and end < len(tag)


def _unwanted(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is none of the article, by its name, by its role or because it is hidden."""
    if name in DROPPED or name in UNREAD or (name == "header" and not in_article):
        return True
    if name in ("html", "body") or not attributes:
        return False
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip() == "true"
        or not ROLES.isdisjoint(attributes.get("role", "").split())
        or bool(HIDDEN.search(attributes.get("style", "")))
    )


def _named(name: str, attributes: dict[str, str]) -> bool:
    """Whether the class or id of an element names what is no article."""
    if name in FORMS or "form" in attributes.get("role", "").split():
        return True
    if name in HOLDS or name in ("html", "body"):
        return False
    return any(NAMES.intersection(re.split(r"[^a-z]+", attributes[k])) for k in ("class", "id") if k in attributes)


class Page:
    """The things of a page in page order and, once its named elements are settled, its blocks and scored items."""

    def __init__(self, html: str) -> None:
        #: (kind or "", how many, text, whether a block begins, article element or 0, innermost named element or 0).
        self.things: list[tuple[str, int, str, bool, int, int]] = []
        #: The named element around each named element, the place of its own thing, and whether it and all around are forms; 0 is the page.
        self.around, self.places, self.forms = [0], [0], [True]
        self.articles = 0
        self._read(html)
        self.settle([True] + [False] * (len(self.around) - 1))

    def _read(self, html: str) -> None:
        stack: list[tuple[str, bool, int, int]] = []
        open_names: Counter[str] = Counter()
        dropping = article = links = named = at = 0

        def close(name: str) -> None:
            nonlocal dropping, article, links, named
            while stack:
                top, dropped, before, outer = stack.pop()
                open_names[top] -= 1
                dropping -= dropped
                links -= top == "a"
                article, named = before, outer
                if top == name:
                    return

        size = len(html)
        ahead: dict[str, int] = {}

        def ends_later(name: str) -> bool:
            """Whether an end tag of an element not read comes yet; every search goes on from the last."""
            if ahead.get(name, -1) < at:
                end = re.compile(rf"</{name}\b", re.I).search(html, at)
                ahead[name] = end.start() if end else size
            return ahead[name] < size

        while at < size:
            m = TOKEN.match(html, at)
            at = m.end()
            if m[2] is None:
                text = m[0]
                if text[0] == "<" and len(text) > 1 or dropping:
                    continue
                words = len(text.split())
                self.things.append((("link word" if links else "word") if words else "", words, text, False, article, named))
                continue
            name, ends = m[2].lower(), bool(m[1])
            if name in RAW and not ends:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else size
                continue
            if not ends and name in BLOCKS and open_names["p"]:
                top = stack[-1][0]
                if top == "p" or (top in UNREAD and len(stack) > 1 and stack[-2][0] == "p" and not ends_later(top)):
                    close("p")
            if not ends and name in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
                close(name)
            if not dropping and (ends or name not in UNREAD):
                kind = name if name in PRIOR or name in KINDS_SET else "other"
                self.things.append((kind, 1, " " if name == "br" else "", name in BLOCKS, 0 if name in HOLDS else article, named))
            if ends:
                if open_names[name]:
                    close(name)
                continue
            attributes, closed = attributes_of(m[3]) if m[3] and not m[3].isspace() else ({}, False)
            if name in VOID or closed and name not in BLOCKS:
                continue
            dropped = _unwanted(name, attributes, bool(article))
            stack.append((name, dropped, article, named))
            open_names[name] += 1
            dropping += dropped
            links += name == "a"
            if not dropping and _named(name, attributes):
                self.things.append(("named", 1, "", False, article, named))
                self.around.append(named)
                self.places.append(len(self.things) - 1)
                self.forms.append(self.forms[named] and (name in FORMS or "form" in attributes.get("role", "").split()))
                named = len(self.around) - 1
            if name in HOLDS and not dropping and not article and self.forms[named]:
                self.articles += 1
                article = self.articles

    def settle(self, read: list[bool]) -> None:
        """Blocks, and (kind, how many, block, article element or 0) of words and tags, of what `read` tells by named element."""
        self.blocks: list[list[str]] = [[]]
        self.items: list[tuple[str, int, int, int]] = []
        for kind, n, text, begins, article, named in self.things:
            if not read[named]:
                continue
            if begins and self.blocks[-1]:
                self.blocks.append([])
            if text:
                self.blocks[-1].append(text)
            if kind:
                self.items.append((kind, n, len(self.blocks) - 1, article))

    def weigh(self, weight: dict[str, float]) -> None:
        """Settle which named elements are read, from the innermost to the outermost, by sums of scores."""
        if len(self.around) == 1:
            return
        parts: list[list] = [[] for _ in self.around]
        inner = dict(zip(self.places[1:], range(1, len(self.places))))
        for at, (kind, n, _, _, article, named) in enumerate(self.things):
            if kind:
                parts[named].append((scored(weight, kind, n, article or not self.articles), inner.get(at, 0)))
        # Of each: its sum, its best run, its best beginning and its best end, less for its name and those inside of it.
        sums: list[tuple[float, float, float, float]] = [NO_SUM] * len(parts)
        read = [True] * len(parts)
        for own in range(len(parts) - 1, -1, -1):
            around = best = 0.0
            for score, _ in parts[own]:
                around = max(0.0, around + score)
                best = max(best, around)
            whole = NO_SUM
            for score, child in parts[own]:
                whole = _joined(whole, (score, max(0.0, score), max(0.0, score), max(0.0, score)))
                if child:
                    read[child] = sums[child][1] + score > best
                    if read[child]:
                        whole = _joined(whole, sums[child])
            sums[own] = whole if self.forms[own] else tuple(x / OVERRULED for x in whole)
        for child in range(1, len(read)):
            read[child] = read[child] and read[self.around[child]]
        self.settle(read)

    def text(self, blocks: list[int]) -> str:
        parts = (" ".join(unescape("".join(self.blocks[b])).split()) for b in blocks)
        return "\n".join(p for p in parts if p)


NO_SUM = (0.0, 0.0, 0.0, 0.0)


def _joined(a: tuple[float, float, float, float], b: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
    """(sum, best run, best beginning, best end) of two runs behind each other."""
    return a[0] + b[0], max(a[1], b[1], a[3] + b[2]), max(a[2], a[0] + b[2]), max(b[3], b[0] + a[3])


KINDS_SET = frozenset(KINDS)


def weights(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log-odds of kinds inside against outside; words above zero, tags below."""
    both = {k: tuple(a + b for a, b in zip(counts.get(k, (0, 0)), PRIOR.get(k, (0, 0)))) for k in {*counts, *PRIOR, *KINDS, "other"}}
    inside, outside = (sum(c[i] for c in both.values()) + len(both) for i in (0, 1))
    odds = {k: math.log((c[0] + 1) / inside) - math.log((c[1] + 1) / outside) for k, c in both.items()}
    return {k: max(LEAST, w) if k.endswith("word") else min(-LEAST, w) for k, w in odds.items()}


def scored(weight: dict[str, float], kind: str, n: int, article: int | bool) -> float:
    """The score of a thing; tags inside of an article element weigh less, on a page without one (True) those of lists."""
    light = article and kind != "named" and not kind.endswith("word") if article is not True else kind in LISTS
    return weight[kind] * n * (IN_ARTICLE if light else 1.0)


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the largest sum; the longest of equal ones that start first."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or (total == best and start == region[0]):
            best, region = total, (start, i + 1)
    return region


def main_text(html: str | None, weight: dict[str, float]) -> str:
    page = Page(html or "")
    page.weigh(weight)
    start, end = best_region([scored(weight, k, n, article or not page.articles) for k, n, _, article in page.items])
    if start == end:
        return ""
    return page.text(list(range(page.items[start][2], page.items[end - 1][2] + 1)))


def kind_counts(html: str | None) -> Counter[tuple[str, bool]]:
    """Kinds inside and outside of the article of a page that names exactly one, else nothing."""
    page, found = Page(html or ""), Counter()
    if page.articles == 1:
        for kind, n, _, article in page.items:
            found[kind, bool(article)] += n
    return found


def learn(pages: DataFrame, max_pages: int = MAX_PAGES) -> dict[str, float]:
    """Scores of kinds from labelled pages among `pages` (page_id, html)."""
    known = pages.where(F.col("html").isNotNull())
    total = known.count()
    picked = known.where(F.pmod(F.xxhash64(F.lit(1), "page_id"), F.lit(1 << 20)) < min(1.0, max_pages / max(1, total)) * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        for batch in batches:
            for html in batch.column("html").to_pylist():
                found.update(kind_counts(html))
        if found:
            kinds, places = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(places), pa.array(list(found.values()), pa.int64())], ["kind", "inside", "n"])

    counted = picked.select("html").mapInArrow(count, "kind string, inside boolean, n bigint")
    rows = counted.groupBy("kind").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("o"))
    return weights({r["kind"]: (r["i"], r["o"]) for r in rows.collect()})


def extract(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """`pages` (html, ...) with `text` and `n_chars`, without `html`."""
    added = ("text", "n_chars")
    others = [f for f in pages.schema.fields if f.name not in (*added, "html")]
    schema = T.StructType([*others, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, weight) for h in batch.column("html").to_pylist()]
            arrays = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], *arrays], [*[f.name for f in others], *added])

    return pages.select(*[f.name for f in others], "html").mapInArrow(read, schema)


@query("op1_main_text")
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html"), learn(pages.select("page_id", "html")))
