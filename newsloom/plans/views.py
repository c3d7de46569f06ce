"""Views that plant news patterns in the driver's tables.

The text is in the common part of Spark SQL and DuckDB SQL: Spark reads it through
`view`, the checks put it in front of their own SQL through `with_views`.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from newsloom.plans.written_pages import values_sql
from newsloom.session import spread

#: The given tables that views read, and what tells their rows apart.
TABLES = {"documents": "doc_id", "pages": "page_id"}

# ---- name -> (views it reads, SQL) ----
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "snippets": ((), """
SELECT * FROM (VALUES
 (0,  'Shares of $tsla rose 5% in Q3 2024 after the company guided to $5.2bn.'),
 (1,  'Revenue fell 7 percent to €3m, with 12 million units sold on March 14.'),
 (2,  'Unemployment was 4.3 per cent, and -2% growth, on 14 March in the UK.'),
 (3,  'Oops, something went wrong'),
 (4,  'All rights reserved.'),
 (5,  'Copyright © 2023 Wire Ltd.'),
 (6,  'Read more: https://wire.test/x?y=1 and www.wire.test/z'),
 (7,  'Story continues below <b>bold</b> claim'),
 (8,  'My portfolio - watch now - 3 min read'),
 (9,  'The company files for bankruptcy under chapter 11.'),
 (10, 'A merger and an acquisition were announced; the CEO steps down.'),
 (11, 'It’s a “profit warning” – analysts downgrade the AT&T and S&P names.'),
 (12, 'Numbers: 1,234.5 and 8.5x and a6 and 7b, 42.'),
 (13, '$7 million, $9billion, £1,000 and 3 trillion'),
 (14, 'Terms and Privacy Policy'),
 (15, 'Repeated line'),
 (16, 'The US GDP, CPI and EPS rose; OPEC and the ECB met in 1999 and 2031.'),
 (17, 'Mass layoffs and a restructuring plan; quarterly results due 3 may.'),
 (18, 'Scott Lehtonen'),
 (19, 'plain text without any marker at all')
) AS t(k, s)"""),
    "news": (("documents", "snippets"), """
SELECT d.doc_id,
  CASE d.doc_id % 10 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'MSFT' WHEN 2 THEN 'TSLA' WHEN 3 THEN 'META' WHEN 4 THEN 'GOOGL' WHEN 5 THEN 'NVDA' WHEN 6 THEN 'AMZN' WHEN 7 THEN 'NA' WHEN 8 THEN 'IBM' END AS ticker,
  CASE WHEN d.doc_id % 41 = 0 THEN NULL ELSE 'Headline ' || CAST(d.doc_id % 600 AS STRING) END AS headline,
  s.s AS summary,
  CASE WHEN d.doc_id % 97 = 0 THEN NULL WHEN d.doc_id % 89 = 0 THEN '   ' WHEN s.k = 15 THEN d.text || chr(10) || s.s || chr(10) || '  REPEATED LINE ' || chr(10) || chr(10) || s.s ELSE d.text || chr(10) || s.s END AS article_text,
  d.text AS body,
  CASE WHEN d.doc_id % 31 = 0 THEN NULL WHEN d.doc_id % 37 = 0 THEN '' ELSE 'https://' || CASE WHEN d.doc_id % 301 % 3 = 0 THEN 'WWW.' ELSE '' END || 'news' || CAST(d.doc_id % 301 % 7 AS STRING) || '.test' || CASE WHEN d.doc_id % 301 % 11 = 0 THEN ':8080' ELSE '' END || '/a/' || CAST(d.doc_id % 301 AS STRING) END AS url,
  1704067200 + (d.doc_id * 7919 % 401) * 86400 + d.doc_id AS published_epoch,
  d.source, d.lang
FROM documents d JOIN snippets s ON s.k = d.doc_id % 20"""),
    "scraped": (("news",), """
SELECT n.doc_id, n.headline, n.source, n.summary, n.url AS url_original,
  CASE WHEN n.doc_id % 4 = 0 THEN NULL ELSE n.url END AS final_url,
  CASE n.doc_id % 5 WHEN 0 THEN '2024-03-01T10:00:05Z' WHEN 1 THEN '2024-03-01T10:00:05' WHEN 2 THEN '2024-03-01T10:00:05+02:00' WHEN 3 THEN '2024-03-01' ELSE 'not a date' END AS published_at,
  CASE n.doc_id % 6 WHEN 0 THEN 'http_status_403' WHEN 1 THEN 'fetch_error:ConnectionError:port=443' WHEN 2 THEN 'got 404 from host' WHEN 3 THEN 'invalid_url' END AS error,
  CASE n.doc_id % 7 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 0 WHEN 3 THEN 700 END AS status,
  CASE WHEN n.doc_id % 3 = 0 THEN NULL ELSE n.article_text END AS full_text,
  n.summary AS content_truncated
FROM news n"""),
    # Pages written by hand; `web` holds one in place of about half of its pages.
    "written": ((), values_sql()),
    "web": (("pages", "written"), """
SELECT p.page_id, replace(p.url, '.example.', '.wire.') AS url,
  CASE p.page_id % 9 WHEN 7 THEN 404 WHEN 8 THEN 0 ELSE 200 END AS status,
  CASE WHEN p.page_id % 9 = 8 THEN NULL WHEN w.html IS NOT NULL THEN w.html ELSE replace(p.html, '<head>', '<head>' || CASE p.page_id % 8
   WHEN 0 THEN '<link rel="canonical" href="https://pub.wire.test/story/1">'
   WHEN 1 THEN '<link rel="Canonical" href="/rel/path">'
   WHEN 2 THEN '<meta property="og:url" content="https://pub.wire.test/og/2">'
   WHEN 3 THEN '<link rel="stylesheet" href="/x.css"><link href="https://pub.wire.test/c?utm_source=a" rel="canonical">'
   WHEN 4 THEN '<link rel="canonical"><meta property="og:url" content="//cdn.wire.test/og">'
   WHEN 5 THEN '<p>Please enable JavaScript and cookies</p>'
   WHEN 6 THEN '<link rel="canonical" href="https://news.google.test/a">'
   ELSE '' END) END AS html
FROM pages p LEFT JOIN written w ON w.k = p.page_id % 25"""),
    # The snapshot holds one row per address: the last capture.
    "snapshot": (("web",), """
SELECT page_id, url, status, html FROM (
  SELECT w.*, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS newest FROM web w
) t WHERE newest = 1"""),
    "leads": (("documents", "web"), """
SELECT d.doc_id, 'Lead ' || CAST(d.doc_id AS STRING) AS headline,
  CASE WHEN d.doc_id % 29 = 0 THEN NULL WHEN d.doc_id % 23 = 0 THEN 'ftp://files.test/x' WHEN d.doc_id % 19 = 0 THEN 'https://login.yahoo.com/?src=' || CAST(d.doc_id AS STRING) WHEN w.url IS NULL OR d.doc_id % 17 = 0 THEN 'https://gone.test/' || CAST(d.doc_id AS STRING) ELSE w.url END AS url_original
FROM documents d LEFT JOIN web w ON w.page_id = CAST(floor(d.doc_id / 4) AS BIGINT)"""),
    "edges": (("documents",), """
SELECT 'https://r.test/' || CAST(doc_id AS STRING) AS from_url,
  CASE WHEN doc_id % 8 = 0 THEN NULL WHEN doc_id % 8 = 7 THEN 'https://r.test/' || CAST(doc_id - 1 AS STRING) WHEN doc_id % 8 = 6 THEN 'https://r.test/' || CAST(doc_id + 1 AS STRING) ELSE 'https://r.test/' || CAST(doc_id - 1 AS STRING) END AS to_url,
  CASE WHEN doc_id % 8 <> 0 THEN 302 WHEN doc_id % 40 = 0 THEN 404 ELSE 200 END AS http_code
FROM documents
UNION ALL
SELECT 'https://long.test/' || CAST(doc_id AS STRING), CASE WHEN doc_id % 41 < 40 THEN 'https://long.test/' || CAST(doc_id + 1 AS STRING) END, CASE WHEN doc_id % 41 < 40 THEN 302 ELSE 200 END
FROM documents"""),
    "visits": (("documents",), """
SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN NULL
  WHEN doc_id % 5 = 0 THEN 'https://long.test/' || CAST(doc_id % 100 AS STRING)
  ELSE 'https://r.test/' || CAST(doc_id % 190 AS STRING) END AS url FROM documents"""),
    "symbols": (("documents",), """
SELECT CASE doc_id % 6 WHEN 0 THEN 'S' || CAST(doc_id % 300 AS STRING) WHEN 1 THEN 'abc' || CAST(doc_id % 90 AS STRING) WHEN 2 THEN 'TOOLONG' || CAST(doc_id % 9 AS STRING) WHEN 3 THEN CAST(doc_id % 50 AS STRING) WHEN 4 THEN 'AAPL' END AS symbol, doc_id
FROM documents"""),
    "lexicon": ((), """
SELECT * FROM (VALUES ('shares','share'),('units','unit'),('companies','company'),('analysts','analyst'),('names','name'),('results','result'),('layoffs','layoff'),('numbers','number'),('rights','right'),('was','wa')) AS t(form, lemma)"""),
    "stopwords": ((), """
SELECT * FROM (VALUES ('the'),('of'),('a'),('an'),('and'),('in'),('it'),('to'),('with'),('on'),('at'),('all'),('were'),('under'),('any'),('without')) AS t(word)"""),
    # Lookup tables as they come: forms and words twice, some of them missing.
    "lexicon_repeats": (("lexicon",), """
SELECT form, lemma FROM lexicon UNION ALL SELECT form, lemma FROM lexicon UNION ALL
SELECT * FROM (VALUES ('shares', 'shar'), ('units', NULL), (NULL, 'nothing'), ('rose', 'rise'), ('rose', 'rose')) AS t(form, lemma)"""),
    "stopwords_repeats": (("stopwords",), """
SELECT word FROM stopwords UNION ALL SELECT word FROM stopwords UNION ALL SELECT * FROM (VALUES (NULL), ('share')) AS t(word)"""),
    "suffixes_repeats": (("suffixes",), """
SELECT suffix FROM suffixes UNION ALL SELECT suffix FROM suffixes UNION ALL SELECT * FROM (VALUES (NULL)) AS t(suffix)"""),
    # Edges captured twice and again; some addresses never answered.
    "captured_edges": (("edges",), """
SELECT from_url, to_url, http_code, CASE WHEN to_url IS NULL AND from_url LIKE '%6' THEN 'timeout' WHEN to_url IS NULL AND from_url LIKE '%4' THEN 'request_error:ConnectionError' WHEN to_url IS NULL AND from_url LIKE '%2' THEN 'error:ValueError' END AS error, 2 AS capture FROM edges
UNION ALL SELECT from_url, 'https://old.test/' || substr(from_url, 9), 302, NULL, 1 FROM edges
UNION ALL SELECT from_url, to_url, http_code, CASE WHEN to_url IS NULL AND from_url LIKE '%6' THEN 'timeout' WHEN to_url IS NULL AND from_url LIKE '%4' THEN 'request_error:ConnectionError' WHEN to_url IS NULL AND from_url LIKE '%2' THEN 'error:ValueError' END, 2 FROM edges"""),
    "finance_news": (("news",), """
SELECT doc_id, headline, summary, lang, published_epoch, 'https://' || CASE doc_id % 9 WHEN 0 THEN 'www.reuters.com' WHEN 1 THEN 'sports.yahoo.com' WHEN 2 THEN 'finance.yahoo.com' WHEN 3 THEN 'notreuters.com' WHEN 4 THEN 'markets.ft.com' WHEN 5 THEN 'blog.test' ELSE 'www.cnbc.com' END || '/a/' || CAST(doc_id % 301 AS STRING) AS url
FROM news"""),
    "suffixes": ((), """
SELECT * FROM (VALUES ('test'),('wire.test'),('com'),('net'),('org'),('example.com'),('yahoo.com'),('*.net'),('!wire.net')) AS t(suffix)"""),
}


def _closure(names: tuple[str, ...]) -> list[str]:
    """The named views and all they read, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in ordered:
            for needed in VIEWS[name][0]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(sql: str, *names: str) -> str:
    """`sql` behind the named views; it may start with further `name AS (...)` clauses."""
    ctes = [f"{n} AS ({VIEWS[n][1]})" for n in _closure(names)]
    head = ",\n".join(ctes)
    if sql.lstrip().upper().startswith("SELECT"):
        return f"WITH RECURSIVE {head}\n{sql}"
    return f"WITH RECURSIVE {head},\n{sql}"


def view(spark: SparkSession, sf_dir: str, name: str, dealt: bool = True) -> DataFrame:
    """One view as a DataFrame over the tables in `sf_dir`, small ones dealt out by row unless not `dealt`."""
    ctes = []
    for table, key in TABLES.items():
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        rows = spread(rows, key) if dealt else rows
        held = f"newsloom_{table}_{zlib.crc32(sf_dir.encode())}{'' if dealt else '_as_is'}"
        rows.createOrReplaceTempView(held)
        ctes.append(f"{table} AS (SELECT * FROM {held})")
    ctes += [f"{n} AS ({VIEWS[n][1]})" for n in _closure((name,))]
    return spark.sql(f"WITH {', '.join(ctes)} SELECT * FROM {name}")
