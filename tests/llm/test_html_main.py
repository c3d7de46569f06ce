"""Main text: hand-written pages with the text a reader would copy, and awkward pages."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import html_main
from newsloom.llm.registry import QUERIES
from tests.llm.data import read, rows_of, text, write

OP = QUERIES["op1_main_text"]
STOCK = html_main.weights({})
WORDS = "Several plain words that make up an ordinary paragraph of running prose"

PAGES = {
    "article and everything around it": (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        "<header><a href=/>Site name here</a><nav><ul><li><a>One</a><li><a>Two</a></ul></nav></header>"
        f"<div class='cookie-notice'>We use cookies and more cookies than you think</div><main><article><h1>Head &amp; line</h1><p>{WORDS}.</p>"
        f"<aside>Read also this</aside><div class=advert><p>Buy this now</p></div><p>{WORDS}&nbsp;again<b>st</b> it.<br>Next</p>"
        "<form><label>Mail</label><input><button>Go</button></form><ul><li>point one</li><li>point two</ul>"
        "<section id=comments><h2>Comments</h2><article class=comment><p>I disagree with all of this, truly</p></article></section>"
        "</article></main><aside class=sidebar><p>Most read articles of the week</p></aside><footer>&copy; 2024 the site and its owners</footer></body></html>",
        f"Head & line\n{WORDS}.\n{WORDS} against it. Next\npoint one\npoint two",
    ),
    "no article element": (
        f"<body><ul class=menu><li><a>Home</a><li><a>News</a></ul><div><h2>Title</h2><p>{WORDS}</p><p>{WORDS}</p><p>End.</p></div><div class='footer'>All rights</div>",
        f"Title\n{WORDS}\n{WORDS}\nEnd.",
    ),
    "references": (f"<article><p>{WORDS} caf&eacute; &#8217;x&#x20AC; &lt;b&gt; &amp;amp; &unknown; &copy</p></article>", f"{WORDS} café ’x€ <b> &amp; &unknown; ©"),
    "quoted marks": (f"<article data-x='a>b'><p title=\"1 > 0\">{WORDS}</p></article>", WORDS),
    "nested boxes": (f"<article><div><div>inner {WORDS}</div> tail of outer</div></article>", f"inner {WORDS}\ntail of outer"),
    "cut off": (f"<nav>a</nav><article><p>{WORDS}<p>second {WORDS[:20]}", f"{WORDS}\nsecond {WORDS[:20].strip()}"),
    "comments in the mark-up": (f"<article><!-- no <p>this</p> --><p>{WORDS}<!-- x -->y</p><!-- open", f"{WORDS}y"),
    "nothing": ("<nav><a>x</a></nav>", ""),
    "plain": ("just  words\n here", "just words here"),
    "white space": (f"<article><p>\n {WORDS}\t  x\r\n</p>\n\n<p> </p></article>", f"{WORDS} x"),
}


@pytest.mark.parametrize("name", PAGES)
def test_written_pages(name):
    html, want = PAGES[name]
    assert html_main.main_text(html, STOCK) == want


def test_best_region_equals_brute_force():
    rng = random.Random(18)
    for _ in range(300):
        s = [rng.choice([-3, -1, -0.5, 0.5, 1, 2]) for _ in range(rng.randint(1, 12))]
        best = max([0.0, *[sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]])
        a, b = html_main.best_region(s)
        assert sum(s[a:b]) == best and (best == 0 or s[a] > 0)


@settings(max_examples=200, deadline=None)
@given(st.text("<>/!-\"'= apdivrtcle&;#1x\n", max_size=80))
def test_any_text_is_read(html):
    got = html_main.main_text(html, STOCK)
    assert got == got.strip() and "  " not in got and "\n\n" not in got


@pytest.mark.parametrize("html", ["<a " * 60_000, "<a \"" * 60_000, "<div>" * 60_000, "<!--" * 60_000, "<p>x" * 60_000, "</p>" * 60_000, "&" * 200_000, "<script>" * 60_000])
def test_long_broken_pages_take_little_time(html):
    start = time.process_time()
    html_main.main_text(html, STOCK)
    assert time.process_time() - start < 10


def test_query_on_awkward_rows(spark, tmp_path):
    rng = random.Random(19)
    body = lambda i: f"<html><body><nav><a>menu {i}</a></nav><article><h1>t {i}</h1><p>{text(rng, 30)}</p></article><footer>f {text(rng, 9)}</footer></body></html>"
    rows = [(i, f"u{i}", body(i)) for i in range(40)] + [(50, None, None), (51, "", ""), (None, "x", "<p>a"), (3, "u3", body(3)), (52, "long", body(52) * 300)]
    sf = write(tmp_path, True, pages=rows)
    got = rows_of(OP(spark, sf))
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[50] == by_id[51] == ""
    for r in read(sf, "pages")[:40]:
        if r["page_id"] != 3:
            assert by_id[r["page_id"]] == r["html"].split("<article><h1>")[1].split("</p>")[0].replace("</h1><p>", "\n")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    kept = html_main.extract(pages, STOCK)
    assert set(kept.columns) == {*pages.columns, "text", "n_chars"} - {"html"} and kept.count() == len(rows)
    assert rows_of(OP(spark, write(tmp_path, pages=[]))) == []


def test_weights_have_their_signs():
    w = html_main.weights({"p": (100, 0), "word": (5, 500), "table": (0, 3)})
    assert w["word"] > 0 and w["p"] < 0 and w["table"] < 0


@pytest.mark.parametrize("attribute", ['href="/the-hidden-cost"', 'title="Hidden"', 'data-toggle="hidden"', 'href="/n?id=comments"', 'data-id="share-3"', "data-role=navigation"])
def test_attributes_are_read_by_their_whole_names(attribute):
    html = f"<article><p>{WORDS}</p><p {attribute}>kept too</p><p>And <a {attribute}>a link</a> in it</p><div {attribute}><p>{WORDS}</p></div></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nkept too\nAnd a link in it\n{WORDS}"


@pytest.mark.parametrize("attribute", ["hidden", 'HIDDEN=""', "aria-hidden='true'", "style='display : none'", "role=search", "x=1 hidden/"])
def test_hidden_elements_are_left_out(attribute):
    assert html_main.main_text(f"<article><p>{WORDS}</p><div {attribute}>not this</div><p>{WORDS}</p></article>", STOCK) == f"{WORDS}\n{WORDS}"


@pytest.mark.parametrize("start, end", [
    ("<article class='post no-sidebar'>", "</article>"), ("<main class=with-sidebar>", "</main>"), ("<div class=category-promotion>", "</div>"),
    ("<div class='layout with-sidebar'><div><p>Start</p><article class=promo>", "</article></div></div>"), ("<div id=share-1><div class=widget-area>", "</div></div>"),
])
def test_names_do_not_delete_the_article(start, end):
    html = f"<body><ul><li><a>One</a><li><a>Two</a></ul>{start}<p>{WORDS}</p><div class=advert>Buy this</div><p>{WORDS}</p><p>{WORDS}</p>{end}<div><p>All rights</p></div></body>"
    assert html_main.main_text(html, STOCK).endswith(f"{WORDS}\n{WORDS}\n{WORDS}")


def test_names_weigh_against_comments():
    comment = f"<li class=comment><div class=comment-body><p>{WORDS}</p></div></li>"
    html = f"<body><div><p>{WORDS}</p><p>{WORDS}</p></div><ol class=comment-list>{comment * 5}</ol></body>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\n{WORDS}"


@pytest.mark.parametrize("html", ["<p class=ad>x" * 60_000, "<div class=ad>x" * 60_000, "<div class=ad>x</div>" * 60_000, "<a b='" * 60_000, "<a b=\"'" * 60_000])
def test_long_pages_of_names_and_quotes_take_little_time(html):
    start = time.process_time()
    html_main.main_text(html, STOCK)
    assert time.process_time() - start < 10


@pytest.mark.parametrize("tag", ["<svg viewBox='0 0 1 1'/>", "<math/>", "<svg><path d=x/><title>t</title></svg>", "<svg a=x/ >icon</svg>", "<select><option>a<option>b</select>"])
def test_pictures_end_with_themselves(tag):
    html = f"<article><p>{WORDS}</p>{tag}<p>rest {WORDS}</p>{tag}<p>last {WORDS}</p></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nrest {WORDS}\nlast {WORDS}"


@pytest.mark.parametrize("name", sorted(html_main.UNREAD))
def test_unclosed_elements_end_with_their_parent(name):
    html = f"<article><p>{WORDS}</p><div><{name} x=1>not this</div><p>rest {WORDS}</p><div><{name}>nor this</{name}></div><p>last {WORDS}</p></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nrest {WORDS}\nlast {WORDS}"
    html = f"<article><p>{WORDS}<{name}>not this<p>rest {WORDS}</p></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nrest {WORDS}"


@pytest.mark.parametrize("quote, other", ["\"'", "'\""])
@pytest.mark.parametrize("size", [100, 4001, 200_000])
def test_quoted_values_of_any_length(quote, other, size):
    value = f"a > b </article> <p> {other} word " * (size // 20)
    html = f"<article><p>{WORDS}</p><div data-x={quote}{value}{quote}><p>rest {WORDS}</p></div></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nrest {WORDS}"


def test_quotes_inside_of_bare_values_and_without_end():
    html = f"<article><p title=it's>{WORDS}</p><p title=x\"y>rest {WORDS}</p><p class=\"x>last {WORDS}</p></article>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\nrest {WORDS}\nlast {WORDS}"


@pytest.mark.parametrize("html", ["<a b=" * 60_000, "<a b=\"" * 60_001, "<a =\"'" * 60_001, "<a b='\"" * 60_001, "<a b" + " " * 500_000, "<a " + "b= " * 200_000, "<a b=\"'>" * 60_001])
def test_broken_quotes_take_little_time(html):
    start = time.process_time()
    html_main.main_text(html, STOCK)
    assert time.process_time() - start < 10


@pytest.mark.parametrize("first, second", [(6, 4), (4, 6), (5, 5), (9, 2)])
def test_the_region_covers_sibling_articles(first, second):
    one, two = ("".join(f"<p>{k} {i} {WORDS}</p>" for i in range(n)) for k, n in (("one", first), ("two", second)))
    html = f"<body><nav><a>One</a></nav><article><h1>Head</h1>{one}</article><article>{two}</article><footer>All rights</footer></body>"
    want = [f"one {i} {WORDS}" for i in range(first)] + [f"two {i} {WORDS}" for i in range(second)]
    assert html_main.main_text(html, STOCK).split("\n")[-len(want) :] == want


def test_the_region_covers_text_around_an_article():
    html = f"<div><article><p>{WORDS}</p><p>{WORDS}</p></article><p>then {WORDS}</p></div>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\n{WORDS}\nthen {WORDS}"


LEARNED = {**html_main.weights({}), "li": -5.6, "div": -7.6, "p": -0.6, "word": 0.9, "link word": 0.05}


@pytest.mark.parametrize("start, end", [
    ('<form id="aspnetForm">', "</form>"), ("<div role=form>", "</div>"), ("<form><fieldset><div role='form'>", "</div></fieldset></form>"),
    ("<form class=with-sidebar>", "</form>"), ("<FORM action=/x><input type=hidden value='a > b'>", ""),
])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div>{}</div>", "<main class=content><div>{}</div></main>"])
@pytest.mark.parametrize("weight", [STOCK, LEARNED])
def test_a_form_around_the_page_is_no_reason_to_drop_it(start, end, inner, weight):
    paragraphs = "".join(f"<p>{i} {WORDS}, {WORDS}</p>" for i in range(9))
    search = "<form action=/search><label>Search</label><input name=q><button>Go</button> Search this site</form>"
    html = f"<body><nav><a>One</a></nav>{start}{search}{inner.format(paragraphs + search)}<div class=comments><p>I disagree</p></div>{end}<footer>All rights</footer></body>"
    assert html_main.main_text(html, weight) == "\n".join(f"{i} {WORDS}, {WORDS}" for i in range(9))


@pytest.mark.parametrize("form", [
    f"<form><label>Mail</label><input><p>Sign up now and get the best of our stories by mail</p></form>",
    "<div role='form'><p>User name and password please</p><input></div>",
])
def test_small_forms_go(form):
    html = f"<body><form>Search</form><article><p>{WORDS}</p>{form}<p>{WORDS}</p></article>{form}</body>"
    assert html_main.main_text(html, STOCK) == f"{WORDS}\n{WORDS}"


@pytest.mark.parametrize("weight", [STOCK, LEARNED])
@pytest.mark.parametrize("list_", ["<ul>{}</ul>", "<div><div><ol>{}</ol></div></div>"])
def test_a_list_is_kept_whole_without_an_article_element(weight, list_):
    items = [f"point {i} {WORDS}" for i in range(50)]
    menu = "<ul class=menu><li><a>Home</a><li><a>News</a></ul>"
    html = f"<body>{menu}<h1>Fifty points</h1>{list_.format(''.join(f'<li>{i}</li>' for i in items))}<footer>All rights</footer></body>"
    assert html_main.main_text(html, weight).split("\n")[-50:] == items
