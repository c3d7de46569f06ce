"""Checked queries on collecting, cleaning and shaping articles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from newsloom.functions.dates import epoch_day, iso_from_epoch
from newsloom.functions.quality import is_good_text
from newsloom.functions.text import light_clean, text_length, word_count
from newsloom.operators import backfill as bf
from newsloom.operators import conform as cf
from newsloom.operators import reports, search
from newsloom.operators.lines import clean_lines
from newsloom.operators.ranking import dedupe, dedupe_chain, first_valid, with_sequential_id
from newsloom.plans import jobs
from newsloom.plans.catalog import checked
from newsloom.plans.url_checks import DOMAIN_SQL, EPOCH_SQL, HTTP_CODE_SQL
from newsloom.plans.views import view
from newsloom.schemas import ANALYSIS

NEWS = ("news",)


def _news(spark, sf):
    return view(spark, sf, "news")


# ---------------------------------------------------------------- quality

GATE_SQL = {
    "basic": "(article_text IS NOT NULL AND length(article_text) >= 100 AND NOT regexp_matches(lower(article_text), 'oops, something went wrong|all rights reserved\\.|terms and privacy policy|my portfolio|watch now|min read|scott lehtonen|patrick seitz'))",
    "strict": "(article_text IS NOT NULL AND length(article_text) >= 100 AND NOT regexp_matches(lower(article_text), 'oops, something went wrong|all rights reserved\\.|terms and privacy policy|my portfolio|watch now|min read|scott lehtonen|patrick seitz|copyright'))",
}


@checked(
    "clean_corpus_tickers",
    f"""SELECT ticker, n FROM (SELECT ticker, count(*) AS n FROM (
      SELECT ticker, row_number() OVER (PARTITION BY article_text ORDER BY doc_id) AS r
      FROM news WHERE {GATE_SQL['strict']}) t WHERE r = 1 AND ticker IS NOT NULL GROUP BY ticker) c
    ORDER BY n DESC, ticker LIMIT 20""",
    NEWS,
)
def _clean_corpus_tickers(spark, sf):
    good = reports.quality_gate(_news(spark, sf).select("doc_id", "ticker", "article_text"), "article_text", 100, "strict")
    return reports.top_tickers(dedupe(good, ["article_text"], ["doc_id"]), 20)


for _preset in ("basic", "strict"):

    @checked(
        f"quality_gate_{_preset}",
        f"SELECT doc_id, ticker, length(article_text) AS n_chars FROM news WHERE {GATE_SQL[_preset]}",
        NEWS,
    )
    def _quality_gate(spark, sf, preset=_preset):
        good = reports.quality_gate(_news(spark, sf), "article_text", 100, preset)
        return good.select("doc_id", "ticker", F.length("article_text").cast("bigint").alias("n_chars"))


@checked(
    "quality_report_overall",
    f"""SELECT count(*) AS rows_before, sum(CASE WHEN {GATE_SQL['strict']} THEN 1 ELSE 0 END)::BIGINT AS rows_after,
      sum(CASE WHEN {GATE_SQL['strict']} THEN 0 ELSE 1 END)::BIGINT AS rows_dropped FROM news""",
    NEWS,
)
def _quality_report_overall(spark, sf):
    return reports.quality_report(_news(spark, sf), "article_text", artefacts="strict")


@checked(
    "quality_report_per_ticker",
    f"""SELECT ticker, count(*) AS rows_before, sum(CASE WHEN {GATE_SQL['basic']} THEN 1 ELSE 0 END)::BIGINT AS rows_after,
      sum(CASE WHEN {GATE_SQL['basic']} THEN 0 ELSE 1 END)::BIGINT AS rows_dropped FROM news GROUP BY ticker""",
    NEWS,
)
def _quality_report_per_ticker(spark, sf):
    return reports.quality_report(_news(spark, sf), "article_text", by="ticker")


@checked("drop_null", "SELECT doc_id, headline FROM news WHERE article_text IS NOT NULL AND headline IS NOT NULL", NEWS)
def _drop_null(spark, sf):
    return cf.drop_null(_news(spark, sf), ["article_text", "headline"]).select("doc_id", "headline")


@checked("drop_blank", "SELECT doc_id FROM news WHERE regexp_matches(article_text, '\\S')", NEWS)
def _drop_blank(spark, sf):
    return cf.drop_blank(_news(spark, sf), "article_text").select("doc_id")


# ---------------------------------------------------------------- text measures

LINES_SQL = """lines AS (SELECT doc_id, pos, trim(line, chr(9) || chr(32) || chr(160)) AS line FROM (
    SELECT doc_id, unnest(string_split(article_text, chr(10))) AS line,
      generate_subscripts(string_split(article_text, chr(10)), 1) AS pos FROM news) t),
  firsts AS (SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY pos) AS r FROM lines WHERE line <> ''),
  cleaned AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS cleaned FROM firsts WHERE r = 1 GROUP BY doc_id)"""
CLEANED_SQL = """SELECT n.doc_id, CASE WHEN n.article_text <> '' THEN coalesce(c.cleaned, '') END AS cleaned
  FROM news n LEFT JOIN cleaned c ON c.doc_id = n.doc_id"""


@checked("light_clean", f"{LINES_SQL} {CLEANED_SQL}", NEWS)
def _light_clean(spark, sf):
    return _news(spark, sf).select("doc_id", light_clean(F.col("article_text")).alias("cleaned"))


@checked("clean_lines_by_grouping", f"{LINES_SQL} {CLEANED_SQL}", NEWS)
def _clean_lines(spark, sf):
    return clean_lines(_news(spark, sf), "doc_id", "article_text").withColumnRenamed("article_text", "cleaned")


@checked(
    "word_count",
    """SELECT doc_id, coalesce(length(article_text), 0)::INTEGER AS text_length,
      coalesce(len(list_filter(regexp_split_to_array(article_text, '\\s+'), lambda w: w <> '')), 0)::INTEGER AS word_count FROM news""",
    NEWS,
)
def _word_count(spark, sf):
    text = F.col("article_text")
    return _news(spark, sf).select(
        "doc_id",
        text_length(text).cast("int").alias("text_length"),
        word_count(text).cast("int").alias("word_count"),
    )


# ---------------------------------------------------------------- dedupe and order


@checked(
    "dedupe_by_url",
    """SELECT doc_id, ticker, url FROM (SELECT doc_id, ticker, url,
      row_number() OVER (PARTITION BY url ORDER BY published_epoch DESC, doc_id) AS r FROM news) t WHERE r = 1""",
    NEWS,
)
def _dedupe_by_url(spark, sf):
    rows = _news(spark, sf).select("doc_id", "ticker", "url", "published_epoch")
    return dedupe(rows, ["url"], [F.desc("published_epoch"), "doc_id"]).drop("published_epoch")


@checked(
    "dedupe_by_url_no_blanks",
    """SELECT doc_id, ticker, url FROM (SELECT doc_id, ticker, url,
      row_number() OVER (PARTITION BY url ORDER BY published_epoch DESC, doc_id) AS r FROM news WHERE url <> '') t WHERE r = 1""",
    NEWS,
)
def _dedupe_by_url_no_blanks(spark, sf):
    rows = _news(spark, sf).select("doc_id", "ticker", "url", "published_epoch")
    return dedupe(rows, ["url"], [F.desc("published_epoch"), "doc_id"], nulls="drop").drop("published_epoch")


@checked(
    "dedupe_by_text",
    """SELECT min(doc_id) AS doc_id, md5(article_text) AS text_md5 FROM news WHERE article_text IS NOT NULL GROUP BY article_text""",
    NEWS,
)
def _dedupe_by_text(spark, sf):
    rows = cf.drop_null(_news(spark, sf).select("doc_id", "article_text"), ["article_text"])
    return dedupe(rows, ["article_text"], ["doc_id"]).select("doc_id", F.md5("article_text").alias("text_md5"))


@checked(
    "dedupe_chain",
    """by_url AS (SELECT * FROM (SELECT doc_id, url, headline, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS r FROM news) t WHERE r = 1)
    SELECT doc_id, url AS url_original, headline FROM (
      SELECT *, row_number() OVER (PARTITION BY headline ORDER BY doc_id) AS h FROM by_url) t WHERE h = 1""",
    NEWS,
)
def _dedupe_chain(spark, sf):
    rows = _news(spark, sf).select("doc_id", F.col("url").alias("url_original"), "headline")
    return dedupe_chain(rows, ["url_original"], ["headline"], order_by=["doc_id"])


@checked(
    "sequential_id",
    "SELECT doc_id, row_number() OVER (ORDER BY published_epoch DESC, doc_id)::BIGINT AS id FROM news",
    NEWS,
)
def _sequential_id(spark, sf):
    rows = _news(spark, sf).select("doc_id", "published_epoch")
    return with_sequential_id(rows, [F.desc("published_epoch"), "doc_id"]).select("doc_id", "id")


@checked(
    "first_valid",
    """SELECT doc_id, article_text, upper(headline) AS headline FROM news WHERE article_text IS NOT NULL AND length(article_text) > 0
       ORDER BY published_epoch, doc_id LIMIT 1""",
    NEWS,
)
def _first_valid(spark, sf):
    text = F.col("article_text")
    valid = text.isNotNull() & (F.length(text) > 0)
    return first_valid(_news(spark, sf), valid, ["published_epoch", "doc_id"]).select(
        "doc_id", "article_text", F.upper("headline").alias("headline")
    )


# ---------------------------------------------------------------- search

def _terms_sql(col: str) -> str:
    terms = "|".join(t.replace(" ", "\\s+") for t in search.FINANCE_TERMS)
    return f"coalesce(regexp_matches({col}, '(?i)\\b({terms})\\b'), false)"


@checked(
    "keyword_search",
    f"SELECT doc_id, summary FROM news WHERE {_terms_sql('headline')} OR {_terms_sql('summary')} OR {_terms_sql('article_text')}",
    NEWS,
)
def _keyword_search(spark, sf):
    return search.keyword_search(_news(spark, sf), ["headline", "summary", "article_text"]).select("doc_id", "summary")


# Hosts of the finance publishers and of others, by page.
PRESS_SQL = """CASE page_id % 7 WHEN 0 THEN 'https://www.reuters.com/a' WHEN 1 THEN 'https://finance.yahoo.com/b'
  WHEN 2 THEN 'https://sports.yahoo.com/c' WHEN 3 THEN 'https://notreuters.com/d' WHEN 4 THEN 'https://uk.finance.yahoo.com:443/e'
  WHEN 5 THEN 'https://FT.com' ELSE url END"""


@checked(
    "domain_filter",
    f"""SELECT page_id, u AS url FROM (SELECT page_id, {PRESS_SQL} AS u FROM web) t
    WHERE regexp_matches(lower(split_part(u, '/', 3)), '^(.*\\.)?(bloomberg\\.com|reuters\\.com|ft\\.com|wsj\\.com|cnbc\\.com|marketwatch\\.com|businessinsider\\.com|forbes\\.com|seekingalpha\\.com|barrons\\.com|investing\\.com|finance\\.yahoo\\.com)(:\\d+)?$')
      AND NOT regexp_matches(lower(split_part(u, '/', 3)), '^(.*\\.)?(sports|autos)\\.yahoo\\.com$')""",
    ("web",),
)
def _domain_filter(spark, sf):
    web = view(spark, sf, "web").select("page_id", F.expr(PRESS_SQL).alias("url"))
    return search.domain_filter(web, "url")


@checked(
    "exclude_domains",
    f"""SELECT page_id, u AS url FROM (SELECT page_id, {PRESS_SQL} AS u FROM web) t
    WHERE NOT regexp_matches(lower(split_part(u, '/', 3)), '^(.*\\.)?(sports|autos)\\.yahoo\\.com$')""",
    ("web",),
)
def _exclude_domains(spark, sf):
    web = view(spark, sf, "web").select("page_id", F.expr(PRESS_SQL).alias("url"))
    return search.domain_filter(web, "url", include=())


AS_OF = dt.date(2025, 2, 5)
DAY_SQL = "(DATE '1970-01-01' + CAST(floor(published_epoch / 86400.0) AS INTEGER))"


def _dated(spark, sf):
    return _news(spark, sf).withColumn("day", epoch_day(F.col("published_epoch")))


@checked(
    "recent_month",
    f"SELECT doc_id, lang, strftime({DAY_SQL}, '%Y-%m-%d') AS day FROM news WHERE lang = 'en' AND {DAY_SQL} BETWEEN DATE '2025-01-06' AND DATE '2025-02-05'",
    NEWS,
)
def _recent_month(spark, sf):
    found = search.recent(_dated(spark, sf), "day", AS_OF, 30, language=("lang", "en"))
    return found.select("doc_id", "lang", F.date_format("day", "yyyy-MM-dd").alias("day"))


@checked(
    "recent_tickers",
    f"""SELECT doc_id, ticker FROM (SELECT doc_id, ticker, row_number() OVER (PARTITION BY doc_id ORDER BY ticker) AS r
    FROM news WHERE ticker IN ('AAPL','NVDA','MSFT','AMZN','GOOGL','TSLA','META') AND {DAY_SQL} BETWEEN DATE '2024-10-08' AND DATE '2025-02-05') t WHERE r = 1""",
    NEWS,
)
def _recent_tickers(spark, sf):
    tickers = ["AAPL", "NVDA", "MSFT", "AMZN", "GOOGL", "TSLA", "META"]
    found = search.recent(_dated(spark, sf), "day", AS_OF, 120, tickers=tickers)
    placed = found.withColumn("precedence", bf.precedence_of(F.col("ticker"), tuple(tickers)))
    return dedupe(placed, ["doc_id"], ["precedence"]).select("doc_id", "ticker")


@checked(
    "top_per_day",
    f"""SELECT doc_id, day FROM (SELECT doc_id, strftime({DAY_SQL}, '%Y-%m-%d') AS day,
      row_number() OVER (PARTITION BY {DAY_SQL} ORDER BY published_epoch DESC, doc_id) AS r FROM news) t WHERE r <= 2""",
    NEWS,
)
def _top_per_day(spark, sf):
    top = search.top_per_day(_dated(spark, sf), "day", [F.desc("published_epoch"), "doc_id"], n=2)
    return top.select("doc_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@checked(
    "search_corpus",
    f"""hits AS (SELECT * FROM news WHERE {_terms_sql('headline')} OR {_terms_sql('summary')} OR {_terms_sql('article_text')}),
    daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {DAY_SQL} ORDER BY published_epoch DESC, doc_id) AS r FROM hits
      WHERE lang = 'en' AND {DAY_SQL} BETWEEN DATE '2024-02-06' AND DATE '2025-02-05') t WHERE r <= 100),
    urls AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY {DAY_SQL}, published_epoch DESC, doc_id) AS u FROM daily) t WHERE u = 1)
    SELECT doc_id, headline, url AS url_original, strftime(epoch_ms(published_epoch * 1000), '%Y-%m-%dT%H:%M:%S') AS published_utc
    FROM (SELECT *, row_number() OVER (PARTITION BY headline ORDER BY {DAY_SQL}, published_epoch DESC, doc_id) AS h FROM urls) t WHERE h = 1""",
    NEWS,
)
def _search_corpus(spark, sf):
    found = jobs.search_corpus(
        _dated(spark, sf), ["headline", "summary", "article_text"], "url", AS_OF, days=365, language=("lang", "en"),
        published="published_epoch", row_id="doc_id", include=(), exclude=(),
    )
    return found.select(
        "doc_id", "headline", F.col("url").alias("url_original"), iso_from_epoch(F.col("published_epoch")).alias("published_utc")
    )


# The job as it is run: a month, the publishers searched and those left out.
@checked(
    "search_corpus_month",
    f"""hits AS (SELECT *, regexp_extract(url, '//([^/]*)', 1) AS host FROM finance_news WHERE {_terms_sql('headline')} OR {_terms_sql('summary')}),
    daily AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {DAY_SQL} ORDER BY published_epoch DESC, doc_id) AS r FROM hits
      WHERE lang = 'en' AND {DAY_SQL} BETWEEN DATE '2025-01-06' AND DATE '2025-02-05'
        AND host IN ('www.reuters.com', 'finance.yahoo.com', 'markets.ft.com', 'www.cnbc.com')) t WHERE r <= 100),
    urls AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY {DAY_SQL}, published_epoch DESC, doc_id) AS u FROM daily) t WHERE u = 1)
    SELECT doc_id, headline, url FROM (SELECT *, row_number() OVER (PARTITION BY headline ORDER BY {DAY_SQL}, published_epoch DESC, doc_id) AS h FROM urls) t WHERE h = 1""",
    ("finance_news",),
)
def _search_corpus_month(spark, sf):
    dated = view(spark, sf, "finance_news").withColumn("day", epoch_day(F.col("published_epoch")))
    found = jobs.search_corpus(
        dated, ["headline", "summary"], "url", AS_OF, language=("lang", "en"), published="published_epoch", row_id="doc_id"
    )
    return found.select("doc_id", "headline", "url")


# ---------------------------------------------------------------- collecting per ticker

# Windows are listed one by one here and matched by date range.
WINDOWS_SQL = f"""w AS (SELECT k, CASE WHEN k = 0 THEN 0 ELSE 7 * k + 1 END AS near, CASE WHEN k = 0 THEN 7 ELSE 7 * k + 8 END AS far FROM range(0, 53) r(k)),
  dated AS (SELECT *, DATE '2025-02-05' - {DAY_SQL} AS ago FROM news WHERE ticker IS NOT NULL),
  raw AS (SELECT d.*, w.k FROM dated d JOIN w ON d.ago BETWEEN w.near AND w.far),
  sizes AS (SELECT ticker, k, count(*) AS n FROM raw GROUP BY ticker, k),
  seen AS (SELECT s.ticker, s.k, coalesce(sum(p.n), 0) AS before FROM sizes s LEFT JOIN sizes p ON p.ticker = s.ticker AND p.k < s.k GROUP BY s.ticker, s.k),
  taken AS (SELECT r.* FROM raw r JOIN seen s ON s.ticker = r.ticker AND s.k = r.k WHERE s.before < {{target}}),
  uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, url ORDER BY k, published_epoch DESC, doc_id) AS u FROM taken WHERE url <> '') t WHERE u = 1),
  kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY k, published_epoch DESC, doc_id) AS r FROM uniq) t WHERE r <= {{target}})"""
TARGET_SQL = "(CASE WHEN {t} IN ('AAPL','MSFT','TSLA','META','GOOGL','NVDA','AMZN') THEN 20 ELSE 5 END)"


def _order():
    return [F.desc("published_epoch"), "doc_id"]


@checked(
    "backfill",
    f"{WINDOWS_SQL.format(target=20)} SELECT doc_id, ticker, url, k AS window_no FROM kept",
    NEWS,
)
def _backfill(spark, sf):
    got = bf.backfill(_dated(spark, sf), AS_OF, _order(), default_target=20, row_id="doc_id")
    return got.select("doc_id", "ticker", "url", "window_no")


MIXED_WINDOWS = (
    WINDOWS_SQL.replace("WHERE s.before < {target}", f"WHERE s.before < {TARGET_SQL.format(t='r.ticker')}")
    .replace("WHERE r <= {target}", f"WHERE r <= {TARGET_SQL.format(t='ticker')}")
)


def _mixed_backfill(spark, sf):
    return bf.backfill(
        _dated(spark, sf), AS_OF, _order(), default_target=5, targets={t: 20 for t in bf.FIXED_TICKERS}, row_id="doc_id"
    )


@checked("backfill_target_table", f"{MIXED_WINDOWS} SELECT doc_id, ticker, url, k AS window_no FROM kept", NEWS)
def _backfill_target_table(spark, sf):
    targets = spark.createDataFrame([*[(t, 20) for t in bf.FIXED_TICKERS], ("AAPL", 7), (None, 99)], "ticker string, target int")
    got = bf.backfill(_dated(spark, sf), AS_OF, _order(), default_target=5, targets=targets, row_id="doc_id")
    return got.select("doc_id", "ticker", "url", "window_no")


@checked("backfill_mixed_targets", f"{MIXED_WINDOWS} SELECT doc_id, ticker, url, k AS window_no FROM kept", NEWS)
def _backfill_mixed_targets(spark, sf):
    return _mixed_backfill(spark, sf).select("doc_id", "ticker", "url", "window_no")


@checked(
    "build_index",
    f"""{MIXED_WINDOWS},
    placed AS (SELECT *, CASE ticker WHEN 'AAPL' THEN 1 WHEN 'MSFT' THEN 2 WHEN 'TSLA' THEN 3 WHEN 'META' THEN 4 WHEN 'GOOGL' THEN 5 WHEN 'NVDA' THEN 6 WHEN 'AMZN' THEN 7 ELSE 8 END AS place FROM kept)
    SELECT doc_id, ticker, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY place, k, published_epoch DESC, doc_id) AS i FROM placed) t WHERE i = 1""",
    NEWS,
)
def _build_index(spark, sf):
    return jobs.corpus_index(_mixed_backfill(spark, sf), _order()).select("doc_id", "ticker", "url")


@checked(
    "valid_symbols",
    "SELECT doc_id, symbol FROM symbols WHERE regexp_matches(symbol, '[A-Z]') AND NOT regexp_matches(symbol, '[a-z]') AND length(symbol) <= 6",
    ("symbols",),
)
def _valid_symbols(spark, sf):
    return bf.valid_symbols(view(spark, sf, "symbols")).select("doc_id", "symbol")


@checked(
    "sample_symbols",
    """SELECT symbol FROM (SELECT DISTINCT symbol FROM symbols WHERE regexp_matches(symbol, '[A-Z]') AND NOT regexp_matches(symbol, '[a-z]')
      AND length(symbol) <= 6 AND symbol NOT IN ('AAPL','MSFT','TSLA','META','GOOGL','NVDA','AMZN')) t ORDER BY md5(symbol || '#42'), symbol LIMIT 20""",
    ("symbols",),
)
def _sample_symbols(spark, sf):
    return bf.sample_symbols(view(spark, sf, "symbols"), n=20)


@checked(
    "union_by_name",
    """SELECT doc_id, ticker, headline, NULL::VARCHAR AS source, 0 AS precedence FROM news WHERE ticker IS NOT NULL
    UNION ALL SELECT doc_id, NULL, headline, source, 1 FROM news""",
    NEWS,
)
def _union_by_name(spark, sf):
    news = _news(spark, sf)
    return bf.union_all([
        cf.drop_null(news, ["ticker"]).select("doc_id", "ticker", "headline"),
        news.select("doc_id", "headline", "source"),
    ])


# ---------------------------------------------------------------- shape

CONFORM_SQL = r"""numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS id, published_at AS t,
    coalesce(final_url, url_original) AS u, coalesce(full_text, content_truncated) AS body FROM scraped)
  SELECT 'finance' AS category, {epoch} AS datetime, coalesce(headline, '') AS headline, id::BIGINT AS id, '' AS image, '' AS related,
    coalesce(source, '') AS source, coalesce(summary, '') AS summary, coalesce(u, '') AS url, coalesce(url_original, '') AS url_original,
    coalesce(status::VARCHAR, '') AS status, {code} AS http_code, coalesce(u, '') AS target_url, {domain} AS domain, coalesce(u, '') AS final_url,
    {code} AS http_status, coalesce(body, '') AS article_text,
    coalesce(len(list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> '')), 0)::INTEGER AS word_count
  FROM numbered"""


def _conform_sql() -> str:
    return CONFORM_SQL.format(epoch=EPOCH_SQL, code=HTTP_CODE_SQL, domain=DOMAIN_SQL.format("u"))


@checked("conform_article", _conform_sql(), ("scraped",))
def _conform_article(spark, sf):
    scraped = view(spark, sf, "scraped").withColumnRenamed("published_at", "publishedAt")
    return cf.conform_article(scraped, ["doc_id"])


@checked(
    "conform_schema",
    "SELECT ticker, headline, summary, article_text, NULL::VARCHAR AS topic FROM news",
    NEWS,
)
def _conform_schema(spark, sf):
    return cf.conform(_news(spark, sf), ANALYSIS)


@checked(
    "analysis_columns",
    "SELECT ticker, headline, summary, article_text, source AS topic FROM news WHERE article_text IS NOT NULL AND headline IS NOT NULL",
    NEWS,
)
def _analysis_columns(spark, sf):
    return cf.analysis_columns(_news(spark, sf).withColumnRenamed("source", "topic"))


@checked(
    "blank_nulls",
    "SELECT doc_id, coalesce(error, '') AS error, coalesce(status::VARCHAR, '') AS status, coalesce(final_url, '') AS final_url FROM scraped",
    ("scraped",),
)
def _blank_nulls(spark, sf):
    rows = view(spark, sf, "scraped").select("doc_id", "error", "status", "final_url")
    return cf.blank_nulls(rows, ["error", "status", "final_url"])


@checked(
    "coalesce_and_constants",
    """SELECT doc_id, coalesce(final_url, url_original) AS url, coalesce(full_text, content_truncated) AS article_text,
      'finance' AS category, '' AS author FROM scraped""",
    ("scraped",),
)
def _coalesce_and_constants(spark, sf):
    rows = view(spark, sf, "scraped")
    return rows.select(
        "doc_id",
        F.coalesce("final_url", "url_original").alias("url"),
        F.coalesce("full_text", "content_truncated").alias("article_text"),
        F.lit("finance").alias("category"),
        cf.col_or(rows, "author").alias("author"),
    )


# ---------------------------------------------------------------- reports


@checked("value_counts", "SELECT ticker, count(*) AS n FROM news WHERE ticker IS NOT NULL GROUP BY ticker", NEWS)
def _value_counts(spark, sf):
    return reports.value_counts(_news(spark, sf), "ticker")


@checked("value_counts_with_null", "SELECT ticker, count(*) AS n FROM news GROUP BY ticker", NEWS)
def _value_counts_with_null(spark, sf):
    return reports.value_counts(_news(spark, sf), "ticker", dropna=False)


@checked(
    "top_headlines",
    "SELECT headline, count(*) AS n FROM news GROUP BY headline ORDER BY n DESC, headline NULLS LAST LIMIT 10",
    NEWS,
)
def _top_headlines(spark, sf):
    return reports.top_values(_news(spark, sf), "headline", 10, dropna=False)


@checked(
    "top_tickers",
    "SELECT ticker, count(*) AS n FROM news WHERE ticker IS NOT NULL GROUP BY ticker ORDER BY n DESC, ticker LIMIT 20",
    NEWS,
)
def _top_tickers(spark, sf):
    return reports.top_tickers(_news(spark, sf), 20)


@checked(
    "share_of_sources",
    "SELECT source, n, round(100.0::DOUBLE * n / sum(n) OVER (), 1) AS percent FROM (SELECT source, count(*) AS n FROM news WHERE source IS NOT NULL GROUP BY source) t",
    NEWS,
)
def _share_of_sources(spark, sf):
    return reports.share(_news(spark, sf), "source")


@checked(
    "stage_counts",
    """SELECT count(*) AS n_rows, count(DISTINCT url) AS distinct_url, count(DISTINCT headline) AS distinct_headline,
      count(DISTINCT ticker) AS distinct_ticker FROM news""",
    NEWS,
)
def _stage_counts(spark, sf):
    return reports.stage_counts(_news(spark, sf), ["url", "headline", "ticker"])


@checked(
    "valid_mask",
    f"SELECT doc_id, {GATE_SQL['basic']} AS is_valid FROM news",
    NEWS,
)
def _valid_mask(spark, sf):
    good = F.coalesce(is_good_text(F.col("article_text")), F.lit(False))
    return _news(spark, sf).select("doc_id", good.alias("is_valid"))
