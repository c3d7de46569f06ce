"""Hand-made cases of the column functions."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, html, quality, text, urls


def values(spark, rows, fn, kind="string"):
    """fn applied to a column `c` holding the rows."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}").coalesce(1)
    return [r[1] for r in df.select("i", fn(F.col("c"))).orderBy("i").collect()]


def test_derive_http_code(spark):
    rows = [
        ("http_status_403", 200, "text", 200),  # the underscore is a word character
        ("fetch_error:ConnectionError:port=443)", 200, "text", 443),
        (None, 700, " ", 0),
        (None, 700, "text", 200),
        (None, 503, None, 503),
        ("got 404 from host", 200, "text", 404),
        ("code 1234", 99, None, 0),
    ]
    df = spark.createDataFrame(rows, "error string, status int, body string, want int")
    got = df.select(quality.derive_http_code(F.col("error"), F.col("status"), F.col("body")).alias("got"), "want")
    assert all(r.got == r.want for r in got.collect())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_to_unix_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [
            "2024-01-01T00:00:05Z", "2024-01-01T10:20:30+02:00", "2024-01-01 00:00:05", "2024-01-01",
            "junk", "12:30", "2024", "2024-1-15", "20240101", None, " 2024-01-01T00:00:05Z ",
        ]
        want = [1704067205, 1704097230, 1704067205, 1704067200] + [None] * 6 + [1704067205]
        assert values(spark, rows, dates.to_unix) == want
        iso = values(spark, [1704067205.0, 1704067205.25, None], dates.iso_from_epoch, "double")
        assert iso == ["2024-01-01T00:00:05", "2024-01-01T00:00:05.250000", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_normalized_domain(spark):
    rows = ["https://WWW.Ex.com:80/p", "x", None, "//u@h.test/a", "https://www.www.a.test", "http://a.test?x=/y"]
    assert values(spark, rows, urls.normalized_domain) == ["ex.com:80", "", "", "u@h.test", "www.a.test", "a.test"]


def test_blacklist_is_a_substring_of_the_host(spark):
    rows = ["https://login.yahoo.com.evil.test/", "https://a.test/login.yahoo.com", None]
    assert values(spark, rows, urls.is_blacklisted) == [True, False, False]


def test_tracking_marks_are_not_anchored(spark):
    rows = ["https://example.org/a", "https://a.test/?utm_source=x", "https://a.test/b", None, "https://newsXgoogle.test"]
    assert values(spark, rows, urls.looks_tracking) == [True, True, False, False, True]
    df = spark.createDataFrame([("https://f.test", "https://example.org/a"), ("https://f.test", "https://g.test/a")], "f string, c string")
    got = [r[0] for r in df.select(urls.choose_original(F.col("f"), F.col("c"))).collect()]
    assert got == ["https://f.test", "https://g.test/a"]


HREFS = [
    "c", "/c/d", "//k.test/z", "?q=1", "#f", "../up", "./x", "../../../far", "a//b", "a/./b/../c", "..", ".", "/..",
    "d/", "?", "x?y=/..#z", "mailto:a@b.test", "https://full.test/a/../b", "javascript:void(0)", "a/b/", "g;x=1/../y",
]
BASES = ["https://h.test/a/b", "https://h.test", "https://h.test/", "http://h.test:8080/a/b/?q=2#frag", "https://h.test/a//b/c"]


def test_absolutize_agrees_with_the_standard_library(spark):
    pairs = [(h, b) for h in HREFS for b in BASES]
    df = spark.createDataFrame(pairs, "h string, b string")
    got = df.select("h", "b", urls.absolutize(F.col("h"), F.col("b")).alias("u")).collect()
    wrong = [(r.h, r.b, r.u, urljoin(r.b, r.h)) for r in got if r.u != urljoin(r.b, r.h)]
    assert not wrong


def test_absolutize_of_nothing(spark):
    df = spark.createDataFrame([(None,), ("",)], "h string")
    assert [r[0] for r in df.select(urls.absolutize(F.col("h"), F.lit("https://h.test"))).collect()] == [None, None]


def test_light_clean(spark):
    rows = ["A\nb\n a \n\nB\nc", "", "   ", None, "x\r\ny x\n\tY ", "É\né\nE"]
    assert values(spark, rows, text.light_clean) == ["A\nb\nc", None, "", None, "x\ny", "É\nE"]


def test_finance_rules(spark):
    def one(name, given):
        return values(spark, [given], lambda c: text.finance_rule(c, name))[0]

    assert one("percent_sign", "-5% up 3 % a-4%, 10%x") == "-__PERCENT__ up __PERCENT__ a__PERCENT__, 10%x"
    assert one("money", "$5.2bn €3m £1,000. $7 million $9billion") == "__MONEY__ __MONEY__ __MONEY__. __MONEY__million $9billion"
    assert one("number", "q1 12 3,4 5. a6 7b 8.5x") == "q1 __NUM__ __NUM__ __NUM__. a6 7b __NUM__5x"
    assert one("quarter", "q3 Q4 q5 xq1") == "__QTR3__ __QTR4__ q5 xq1"
    assert one("boilerplate", "a\nRead more: b\nc copyright © d\ne") == "a\n\nc \ne"
    assert one("month_day", "march 14 and may 3rd") == "__DATE__ and may 3rd"
    assert one("cashtag", "$tsla $12 $toolongticker") == "__TICKER__ $12 $toolongticker"


def test_normalize_finance(spark):
    rows = [None, "  ", "It’s  “up” – 5%\n in <b>Q3</b> 2024: $TSLA", "see www.a.test/x now", "Revenue of $5.2bn, 7 per  cent, 3 may"]
    want = ["", "", "it's \"up\" - __PERCENT__ in __QTR3__ __YEAR__: __TICKER__", "see now", "revenue of __MONEY__, __PERCENT__, __DATE__"]
    assert values(spark, rows, text.normalize_finance) == want
    kept = values(spark, ["The ECB and 5 Percent in Q2"], lambda c: text.normalize_finance(c, lowercase_first=False))
    assert kept == ["The ECB and __PERCENT__ in __QTR2__"]


def test_quality(spark):
    rows = ["x" * 99, "x" * 100, None, "Copyright " + "x" * 100, "x" * 100 + " Patrick Seitz", "é" * 100]
    good = lambda preset: [bool(v) for v in values(spark, rows, lambda c: quality.is_good_text(c, 100, preset))]
    assert good("basic") == [False, True, False, True, False, True]
    assert good("strict") == [False, True, False, False, False, True]


def test_consent_is_looked_for_at_the_top(spark):
    phrase = "BEFORE continuing"
    rows = [phrase, "x" * 20_000 + phrase, "x" * (20_000 - len(phrase)) + phrase, None, ""]
    assert values(spark, rows, quality.looks_like_consent) == [True, False, True, False, False]


def test_word_count_and_length(spark):
    rows = ["a  b c\n", "", None, "  "]
    assert values(spark, rows, text.word_count) == [3, 0, 0, 0]
    assert values(spark, ["😀é", None], text.text_length) == [2, 0]


def test_ngrams(spark):
    def joined(c):
        return F.array_join(text.ngrams(text.words(c), 1, 3), "|")

    assert values(spark, ["aa b CC dd", "aa", "", "é1 _x"], joined) == ["aa|cc|dd|aa cc|cc dd|aa cc dd", "aa", "", "é1|_x|é1 _x"]


PAGE = """<html><head><!-- <link rel="canonical" href="https://no.test"> -->
<script>var a = '<link rel="canonical" href="https://no.test">';</script>{head}</head>
<body><nav>Menu</nav><article><h1>Head &amp; shoulders</h1><p>Body<br>text</p><table><tr><td>cell</td></tr></table></article>
<aside>Side</aside><footer>End</footer></body></html>"""


def test_extract_canonical(spark):
    heads = [
        ("<link rel='canonical' href='/a?x=1&amp;y=2'>", "https://h.test/a?x=1&y=2"),
        ("<link data-href='z' rel=canonical href=b>", "https://h.test/d/b"),
        ("<link rel='canonical'><link rel='canonical' href='/second'>", None),
        ("<link rel='canonical'><meta property='og:url' content='https://og.test/'>", "https://og.test/"),
        ("<meta content=\"https://og.test/2\" property=\"og:url\"/>", "https://og.test/2"),
        ("<link rel='CANONICAL nofollow' href='https://up.test'>", "https://up.test"),
        ("", None),
    ]
    got = values(spark, [PAGE.format(head=h) for h, _ in heads] + [None], lambda c: html.extract_canonical(c, F.lit("https://h.test/d/e")))
    assert got == [want for _, want in heads] + [None]


def test_page_texts(spark):
    page = PAGE.format(head="<title>T</title>")
    assert values(spark, [page, "<p>x</p>", None], html.main_text) == ["Head & shoulders\nBody\ntext", None, None]
    assert values(spark, [page], html.readable_text) == ["Head & shoulders\nBody\ntext\ncell"]
    assert values(spark, [page], html.whole_text) == ["T\nMenu\nHead & shoulders\nBody\ntext\ncell\nSide\nEnd"]


def test_extraction_falls_back(spark):
    long = "word " * 60
    rows = [
        (200, f"<body><article>{long}</article></body>", "main"),
        (200, f"<body><article>short</article><p>{long}</p></body>", "readable"),
        (200, f"<body><nav>{long}</nav><p>short</p></body>", "whole"),
        (200, "<body>short</body>", None),
        (404, f"<body><article>{long}</article></body>", "retry"),
        (0, None, None),
    ]
    df = spark.createDataFrame(rows, "status int, html string, want string")
    best = df.select(html.extract_best(F.col("status"), F.col("html")).alias("b"), "want").collect()
    assert [r.b.tier for r in best] == [r.want for r in best]
    assert best[4].b.text is None
    second = spark.createDataFrame([(404, "x", f"<article>{long}</article>"), (200, "x", f"<article>{long}</article>")], "s int, h string, r string")
    tiers = second.select(html.extract_best(F.col("s"), F.col("h"), F.col("r")).alias("b")).collect()
    assert [(r.b.tier, r.b.text) for r in tiers] == [("retry", long.strip()), ("second_capture", long.strip())]
