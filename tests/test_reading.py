"""The page reader: pages written by hand, its tree, its references, and pages that are broken on purpose."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.functions.reading import Page, attributes, text_of, value_of
from newsloom.plans.written_pages import LONG, PAGES


def lines(text):
    found = [re.sub(r"[ \t]+", " ", line).strip() for line in re.split(r"[\r\n]", text)]
    return "~".join(line for line in found if line) or None


@pytest.mark.parametrize("place", [p[0] for p in PAGES])
def test_written_pages(place):
    _, html, main, readable, whole, canonical = next(p for p in PAGES if p[0] == place)
    page = Page(html)
    assert (lines(page.main()), lines(page.readable()), lines(page.whole())) == (main, readable, whole)
    assert (page.address() or None) == (canonical and canonical.removeprefix("^"))


@pytest.mark.parametrize("raw, text, value", [
    ("&copy;&copy &copyx &copy=1", "©© ©x ©=1", "©© &copyx &copy=1"),
    ("&notin; &notit; &not", "∉ ¬it; ¬", "∉ &notit; ¬"),
    ("&#65;&#x42 &#128;&#xD800;", "AB €�", "AB €�"),
    ("&amp;lt; &AMP &nosuch; & &;", "&lt; & &nosuch; & &;", "&lt; & &nosuch; & &;"),
    ("a&nbsp;b\xa0c&#160;d", "a b\xa0c d", "a\xa0b\xa0c\xa0d"),
])
def test_references(raw, text, value):
    assert text_of(raw) == text and value_of(raw) == value


def test_attributes_count_by_whole_name():
    got = attributes(""" title="a rel=canonical href=/wrong" REL = 'stylesheet' rel=second href=/s.css?x=1&amp;y data-href=z hidden/""")
    assert got == {"title": "a rel=canonical href=/wrong", "rel": "stylesheet", "href": "/s.css?x=1&y", "data-href": "z", "hidden": ""}


def test_every_node_lies_inside_its_parent():
    for _, html, *_ in PAGES:
        page = Page(html)
        for node in range(1, len(page.names)):
            up = page.parents[node]
            assert page.begins[up] < page.begins[node] < page.ends[node] < page.ends[up] + (up == 0)


@pytest.mark.parametrize("html, tree", [
    ("<p>a<p>b<div>c</div>", "html>p html>p html>div"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "html>ul ul>li ul>li li>ul ul>li ul>li"),
    ("<table><tr><td>a<td>b<tr><th>c</table>x", "html>table table>tr tr>td tr>td table>tr tr>th"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "html>dl dl>dt dl>dd dl>dt"),
    ("<head><meta><title>t</title><p>x</head><body>y", "html>head head>meta head>title html>p html>body"),
    ("<div><b>x</div>y", "html>div div>b"),
    ("<table><tr><td><p>x</table><p>y", "html>table table>tr tr>td td>p html>p"),
])
def test_implied_ends(html, tree):
    page = Page(html)
    assert " ".join(f"{page.names[page.parents[n]]}>{page.names[n]}" for n in range(1, len(page.names))) == tree


def test_more_paragraphs_win_and_links_lose():
    box = lambda inner, n, name="div": f"<{name}>{inner * n}</{name}>"
    text, link = f"<p>{LONG}</p>", f"<p><a href=/x>{LONG}</a></p>"
    assert lines(Page(f"<body>{box(link, 9)}{box(text, 3)}</body>").readable()).count(LONG) == 3
    assert lines(Page(f"<body>{box(text, 5)}<section class=sidebar>{text * 9}</section></body>").readable()).count(LONG) == 5
    wrapped = f"<body><div class=content><div>{text}</div><div>{text}</div><div>{text}</div></div><div>{text}</div></body>"
    assert lines(Page(wrapped).readable()).count(LONG) == 3


@settings(max_examples=300, deadline=None)
@given(st.text("<>/!-\"'= apdivrtcle&;#1xhb\n", max_size=100))
def test_any_text_is_read(html):
    page = Page(html)
    assert all(isinstance(t, str) for t in (page.main(), page.readable(), page.whole(), page.address()))
    assert -1 not in page.ends


@pytest.mark.parametrize("html", ["<a " * 40_000, "<div>" * 40_000, "<!--" * 40_000, "<p>x" * 40_000, "</p>" * 40_000, "&" * 100_000, "<li>" * 20_000, "<a b=" * 40_000, "<td><p>" * 20_000])
def test_long_broken_pages_take_little_time(html):
    start = time.process_time()
    page = Page(html)
    page.main(), page.readable(), page.whole()
    assert time.process_time() - start < 20
