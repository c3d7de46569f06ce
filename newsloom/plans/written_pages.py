"""Pages written by hand, with what a reader of each page would say is in it; `web` plants them among the captured ones.

Columns: place, page, text of the article, of the readable part and of the whole page (lines are parted by "~"), canonical address
(relative to `https://` and the host of the page where it begins with "^").
"""

from __future__ import annotations

LONG = "This paragraph is long enough to count, with commas, with clauses, and with hardly a link in it, so that it speaks for what is around it"

PAGES: list[tuple[int, str, str | None, str | None, str | None, str | None]] = [
    # Articles inside of articles, one of them in a slash-closed tag, none closed again.
    (10, "<article><p>One</p><article/><p>Two</p></article>", "One~Two", "One~Two", "One~Two", None),
    (11, "<html><body><article><div><article>inner</article> tail of outer</div></article></body></html>", "inner~tail of outer", "inner~tail of outer", "inner~tail of outer", None),
    # Nothing is ever closed.
    (12, "<body><nav><ul><li>Home<li>News</ul></nav><main><p>First<p>Second<table><tr><td>a<td>b<tr><td>c</table><p>Third", "First~Second~Third", "First~Second~a~b~c~Third", "Home~News~First~Second~a~b~c~Third", None),
    # Quoted marks; a name inside of another attribute's value is no attribute.
    (13, '<head><link title="a rel=canonical href=/wrong" rel="stylesheet" href="/s.css"><link data-x="a>b" rel=canonical href=/right></head><main>m <nav>x<nav>y</nav>z</nav> tail</main>', "m~tail", "m~tail", "m~x~y~z~tail", "^/right"),
    # References by their longest names, with and without a semicolon; in attributes only whole ones.
    (14, "<link rel=canonical href=\"/q?a=1&copy=2&amp;b=3&para;\"><article><p title=\"x > y\">Caf&eacute &#8217;s &#x20AC;5 &amp;lt; &unknown; &copy &notit; &hellip;&NotEqualTilde;&nbsp;end &#128;&#0;</article>", "Café ’s €5 &lt; &unknown; © ¬it; …≂̸ end €�", "Café ’s €5 &lt; &unknown; © ¬it; …≂̸ end €�", "Café ’s €5 &lt; &unknown; © ¬it; …≂̸ end €�", "^/q?a=1&copy=2&b=3¶"),
    # Scripts, comments and styles hold no markup; a comment that never ends takes the rest.
    (15, '<!-- <article>no</article> --><article><script>if (a > b) x = "</p><article>";</script><p>Text<table><tr><td>c<table><tr><td>d</table></table></p>end</article><p>behind</p><!-- open <p>never', "Text~end", "Text~c~d~end", "Text~c~d~end~behind", None),
    # No article element: the box whose paragraphs count most, not the comments, however many, nor the links.
    (16, f'<body><div class="menu"><p><a href=/1>One, two, three, four</a></p></div><div id=left><p><a href=/2>{LONG}</a></p><p><a href=/3>{LONG}</a></p></div><div id="box"><h1>Title</h1><p>{LONG}.</p><p>{LONG}!</p><div class="share">Share this</div></div><div class="comments"><p>{LONG} I disagree.</p><p>{LONG} So do I.</p><p>{LONG} Me too.</p></div></body>',
     None, f"Title~{LONG}.~{LONG}!", f"One, two, three, four~{LONG}~{LONG}~Title~{LONG}.~{LONG}!~Share this~{LONG} I disagree.~{LONG} So do I.~{LONG} Me too.", None),
    # Brothers of the best box that count enough, or are paragraphs with hardly a link, belong to it.
    (17, f"<body><div><section>{f'<p>{LONG}.</p>' * 5}</section><p>Short end of it.</p><p>no end mark</p><p><a href=/x>Read this too.</a></p><section><p>{LONG}.</p><p>{LONG}, again.</p></section></div><footer><p>All rights</p></footer></body>",
     None, f"{f'{LONG}.~' * 5}Short end of it.~{LONG}.~{LONG}, again.", f"{f'{LONG}.~' * 5}Short end of it.~no end mark~Read this too.~{LONG}.~{LONG}, again.~All rights", None),
    # Without a paragraph the body counts, marked or not.
    (18, "<title>Head &amp; title</title><body>Bare <b>te</b>xt<br>next<aside>side</aside></body>", None, "Bare text~next", "Head & title~Bare text~next~side", None),
    (19, "plain text <b>only", None, "plain text only", "plain text only", None),
    # An address of the property, after a canonical link without one; names in capitals, single quotes, blanks around "=".
    (20, "<META PROPERTY = 'og:url' CONTENT = 'https://cdn.wire.test//a?x=&amp;y'><LINK REL='Canonical'><ARTICLE>one<ASIDE>q<aside>r</ASIDE>s</aside> two<BR>three</ARTICLE><article>other</article>", "one~two~three", "one~two~three~other", "one~q~r~s~two~three~other", "https://cdn.wire.test//a?x=&y"),
    # Quotes that are none, stray end tags, elements closed by their parents.
    (21, "<article><p title=it's class=a\"b>It</p></div></p>goes<span><b>on</article></section><p>after</p>", "It~goeson", "It~goeson", "It~goeson~after", None),
]


def _sql(value: str | int | None) -> str:
    if isinstance(value, int):
        return str(value)
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"


def values_sql() -> str:
    """The pages as rows of (k, html, main, readable, whole, canonical) in the SQL that both engines read."""
    rows = ",\n ".join(f"({', '.join(_sql(v) for v in row)})" for row in PAGES)
    lines = ", ".join(f"replace({c}, '~', chr(10)) AS {c}" for c in ("main", "readable", "whole"))
    return f"SELECT k, html, {lines}, canonical FROM (VALUES\n {rows}) AS t(k, html, main, readable, whole, canonical)"
