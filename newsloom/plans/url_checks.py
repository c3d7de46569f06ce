"""Checked queries on addresses, dates, fetch outcomes and redirects."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.functions.dates import epoch_day, iso_from_epoch, to_unix
from newsloom.functions.quality import derive_http_code, fetch_error, looks_like_consent
from newsloom.functions.urls import (
    absolutize,
    choose_original,
    is_blacklisted,
    is_http_url,
    looks_tracking,
    normalized_domain,
)
from newsloom.operators.pages import pick_url_column, with_registered_domain
from newsloom.operators.redirects import enrich_urls, resolve_redirects
from newsloom.operators.reports import top_values
from newsloom.plans.catalog import checked
from newsloom.plans.views import view

DOMAIN_SQL = r"regexp_replace(lower(coalesce(regexp_extract({0}, '^(?:[^:/?#]+:)?//([^/?#]*)', 1), '')), '^www\.', '')"


@checked(
    "normalized_domain",
    f"SELECT doc_id, url, {DOMAIN_SQL.format('url')} AS domain FROM news",
    ("news",),
)
def _normalized_domain(spark, sf):
    return view(spark, sf, "news").select(
        "doc_id", "url", normalized_domain(F.col("url")).alias("domain")
    )


@checked(
    "url_validity",
    """SELECT doc_id, url_original,
      coalesce(starts_with(url_original, 'http'), false) AS is_http,
      coalesce(regexp_matches(split_part(split_part(lower(url_original), '//', 2), '/', 1),
        'consent\\.yahoo\\.com|guce\\.yahoo\\.com|login\\.yahoo\\.com|consent\\.google\\.com'), false) AS is_blacklisted
    FROM leads""",
    ("leads",),
)
def _url_validity(spark, sf):
    url = F.col("url_original")
    return view(spark, sf, "leads").select(
        "doc_id",
        "url_original",
        is_http_url(url).alias("is_http"),
        is_blacklisted(url).alias("is_blacklisted"),
    )


TRACKING_SQL = "regexp_matches({0}, '(?i)utm_|fbclid=|ref=|rss|feedproxy|news.google|amp/?')"


@checked(
    "looks_tracking",
    f"SELECT page_id, url, {TRACKING_SQL.format('url')} AS is_tracking FROM web",
    ("web",),
)
def _looks_tracking(spark, sf):
    return view(spark, sf, "web").select("page_id", "url", looks_tracking(F.col("url")).alias("is_tracking"))


HREF_SQL = """CASE page_id % 9 WHEN 0 THEN '//cdn.wire.test/z?a=1' WHEN 1 THEN '/abs/path#top'
  WHEN 2 THEN '?only=query' WHEN 3 THEN '#only-fragment' WHEN 4 THEN 'https://full.wire.test/a/../b'
  WHEN 5 THEN 'mailto:desk@wire.test' WHEN 6 THEN '' WHEN 7 THEN 'sub/page?x=2' END"""


@checked(
    "absolutize",
    rf"""links AS (SELECT page_id, url, {HREF_SQL} AS href,
        regexp_extract(url, '^([a-z]+):', 1) AS scheme,
        regexp_extract(url, '^[a-z]+://[^/?#]*') AS site,
        regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(url, '\?[^#]*') AS query FROM web)
    SELECT page_id, url, href, CASE
        WHEN href IS NULL OR href = '' THEN NULL
        WHEN regexp_matches(href, '^(https?://|mailto:)') THEN href
        WHEN starts_with(href, '//') THEN scheme || ':' || href
        WHEN starts_with(href, '/') THEN site || href
        WHEN starts_with(href, '?') THEN site || path || href
        WHEN starts_with(href, '#') THEN site || path || query || href
        ELSE site || regexp_replace(path, '[^/]*$', '') || href END AS absolute
    FROM links""",
    ("web",),
)
def _absolutize(spark, sf):
    links = view(spark, sf, "web").select("page_id", "url", F.expr(HREF_SQL).alias("href"))
    return links.withColumn("absolute", absolutize(F.col("href"), F.col("url")))


CANON_SQL = """CASE page_id % 5 WHEN 0 THEN 'https://pub.wire.test/story' WHEN 1 THEN 'https://pub.wire.test/s?utm_source=x'
  WHEN 2 THEN '/relative' WHEN 3 THEN 'http://site.example.org/a' END"""


@checked(
    "choose_original",
    f"""SELECT page_id, CASE WHEN starts_with(c, 'http') AND NOT {TRACKING_SQL.format('c')} THEN c ELSE url END AS url_original
    FROM (SELECT page_id, url, {CANON_SQL} AS c FROM web) t""",
    ("web",),
)
def _choose_original(spark, sf):
    web = view(spark, sf, "web")
    return web.select("page_id", choose_original(F.col("url"), F.expr(CANON_SQL)).alias("url_original"))


# The longest rule is found here by trying every rule on every distinct host.
REGISTERED_SQL = r"""hosts AS (SELECT DISTINCT regexp_replace(regexp_replace(regexp_extract(lower(url), '^(?:[a-z]+:)?(?://)?([^/?#]*)', 1), '^.*@', ''), ':\d*$', '') AS host FROM addresses),
rules AS (SELECT suffix, CASE WHEN suffix LIKE '!%' THEN regexp_replace(suffix, '^![^.]*\.', '') WHEN suffix LIKE '*.%' THEN substr(suffix, 3) ELSE suffix END AS base FROM suffixes),
hits AS (SELECT host, suffix LIKE '!%' AS exception, CASE
    WHEN suffix LIKE '!%' AND (host = substr(suffix, 2) OR ends_with(host, '.' || substr(suffix, 2))) THEN base
    WHEN suffix LIKE '*.%' AND ends_with(host, '.' || base) THEN regexp_extract(host, '[^.]+\.' || replace(base, '.', '\.') || '$')
    WHEN suffix NOT LIKE '!%' AND suffix NOT LIKE '*.%' AND (host = base OR ends_with(host, '.' || base)) THEN base END AS public
  FROM hosts JOIN rules ON true),
best AS (SELECT host, arg_max(public, (CASE WHEN exception THEN 1000 ELSE 0 END) + length(public)) AS public FROM hits WHERE public IS NOT NULL GROUP BY host),
domains AS (SELECT h.host, CASE WHEN b.public IS NULL THEN regexp_extract(h.host, '[^.]*$')
    WHEN h.host = b.public THEN '.' || b.public
    ELSE regexp_extract(substr(h.host, 1, length(h.host) - length(b.public) - 1), '[^.]*$') || '.' || b.public END AS domain
  FROM hosts h LEFT JOIN best b ON b.host = h.host WHERE h.host <> '')"""


DOMAINS_SQL = f"""addresses AS (SELECT page_id, url FROM web), {REGISTERED_SQL}
    SELECT a.page_id, a.url, d.domain FROM addresses a JOIN domains d
      ON d.host = regexp_replace(regexp_extract(lower(a.url), '^[a-z]+://([^/?#]*)', 1), ':\\d*$', '')"""


@checked("registered_domain", DOMAINS_SQL, ("web", "suffixes"))
def _registered_domain(spark, sf):
    web = view(spark, sf, "web").select("page_id", "url")
    return with_registered_domain(web, "url", view(spark, sf, "suffixes"), spread_by=["page_id"])


@checked("registered_domain_by_join", DOMAINS_SQL, ("web", "suffixes"))
def _registered_domain_by_join(spark, sf):
    web = view(spark, sf, "web").select("page_id", "url")
    return with_registered_domain(web, "url", view(spark, sf, "suffixes"), spread_by=["page_id"], inline_rules=0)


NULL_RULE_SQL = "one_each AS (SELECT DISTINCT suffix FROM suffixes_repeats WHERE suffix IS NOT NULL), " + DOMAINS_SQL.replace("FROM suffixes", "FROM one_each")

for _route, _rules in (("", 20_000), ("_by_join", 0)):

    @checked(f"registered_domain_null_rule{_route}", NULL_RULE_SQL, ("web", "suffixes_repeats"))
    def _registered_domain_null_rule(spark, sf, rules=_rules):
        web = view(spark, sf, "web").select("page_id", "url")
        return with_registered_domain(web, "url", view(spark, sf, "suffixes_repeats"), spread_by=["page_id"], inline_rules=rules)


@checked(
    "pick_url_column",
    """SELECT 'where_found' AS url_column, count(*) AS n_rows,
      sum(CASE WHEN starts_with(url, 'http') THEN 1 ELSE 0 END)::BIGINT AS n_http FROM news""",
    ("news",),
)
def _pick_url_column(spark, sf):
    news = view(spark, sf, "news").select("headline", F.col("url").alias("where_found"))
    name = pick_url_column(news)
    return news.agg(
        F.lit(name).alias("url_column"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_http_url(F.col(name))).alias("n_http"),
    )


EPOCH_SQL = r"""CASE WHEN regexp_matches(t, '^\d{4}-\d{2}-\d{2}([T ].*)?$') THEN
    CASE WHEN regexp_matches(t, '[T ].*(Z|[+-]\d{2}(:?\d{2})?)$') THEN epoch(try_cast(t AS TIMESTAMPTZ))
    ELSE epoch(try_cast(t AS TIMESTAMP)) END END::BIGINT"""


@checked(
    "to_unix",
    f"SELECT doc_id, t AS published_at, {EPOCH_SQL} AS published_epoch FROM (SELECT doc_id, published_at AS t FROM scraped) s",
    ("scraped",),
)
def _to_unix(spark, sf):
    return view(spark, sf, "scraped").select(
        "doc_id", "published_at", to_unix(F.col("published_at")).alias("published_epoch")
    )


@checked(
    "iso_from_epoch",
    """SELECT doc_id, strftime(epoch_ms(published_epoch * 1000), '%Y-%m-%dT%H:%M:%S') AS published_utc,
      strftime(epoch_ms(published_epoch * 1000 + 250), '%Y-%m-%dT%H:%M:%S.%f') AS with_fraction,
      strftime(epoch_ms(published_epoch * 1000), '%Y-%m-%d') AS published_day FROM news""",
    ("news",),
)
def _iso_from_epoch(spark, sf):
    epoch = F.col("published_epoch")
    return view(spark, sf, "news").select(
        "doc_id",
        iso_from_epoch(epoch).alias("published_utc"),
        iso_from_epoch(epoch + F.lit(0.25)).alias("with_fraction"),
        F.date_format(epoch_day(epoch), "yyyy-MM-dd").alias("published_day"),
    )


HTTP_CODE_SQL = r"""CASE WHEN regexp_matches(error, '\b\d{3}\b') THEN regexp_extract(error, '\b(\d{3})\b', 1)::INTEGER
    WHEN status BETWEEN 100 AND 599 THEN status
    WHEN full_text IS NULL OR trim(full_text) = '' THEN 0 ELSE 200 END"""


@checked(
    "derive_http_code",
    f"SELECT doc_id, error, status, {HTTP_CODE_SQL} AS http_code FROM scraped",
    ("scraped",),
)
def _derive_http_code(spark, sf):
    code = derive_http_code(F.col("error"), F.col("status"), F.col("full_text"))
    return view(spark, sf, "scraped").select("doc_id", "error", "status", code.alias("http_code"))


@checked(
    "looks_like_consent",
    """SELECT page_id, coalesce(regexp_matches(substr(html, 1, 20000),
      '(?i)Yahoo is part of the Yahoo family of brands|Will be right back|enable JavaScript and cookies|before continuing'), false) AS is_consent
    FROM web""",
    ("web",),
)
def _looks_like_consent(spark, sf):
    return view(spark, sf, "web").select("page_id", looks_like_consent(F.col("html")).alias("is_consent"))


@checked(
    "fetch_error",
    """SELECT page_id, CASE WHEN status = 0 THEN 'fetch_error:NoResponse:no response captured'
      WHEN status <> 200 THEN 'http_status_' || status
      WHEN html ILIKE '%enable JavaScript and cookies%' THEN 'consent_or_block_detected' END AS error
    FROM web""",
    ("web",),
)
def _fetch_error(spark, sf):
    error = fetch_error(F.col("url"), F.col("status"), F.col("html"))
    return view(spark, sf, "web").select("page_id", error.alias("error"))


@checked(
    "error_counts",
    """SELECT coalesce(error, '(none)') AS error, n FROM (
      SELECT CASE WHEN status = 0 THEN 'fetch_error:NoResponse:no response captured'
        WHEN status <> 200 THEN 'http_status_' || status
        WHEN html ILIKE '%enable JavaScript and cookies%' THEN 'consent_or_block_detected' END AS error,
      count(*) AS n FROM web GROUP BY 1) t ORDER BY n DESC, error NULLS LAST LIMIT 10""",
    ("web",),
)
def _error_counts(spark, sf):
    error = fetch_error(F.col("url"), F.col("status"), F.col("html"))
    counts = top_values(view(spark, sf, "web").select(error.alias("error")), "error", 10, dropna=False)
    return counts.withColumn("error", F.coalesce("error", F.lit("(none)")))


# Hop by hop, as a browser would; a chain may take 30 hops.
REDIRECT_SQL = """walk AS (
  SELECT DISTINCT url, url AS here, 0 AS hops FROM wanted WHERE url IS NOT NULL
  UNION ALL
  SELECT w.url, e.to_url, w.hops + 1 FROM walk w JOIN edges e ON e.from_url = w.here
  WHERE e.to_url IS NOT NULL AND w.hops <= 30),
final AS (SELECT url, arg_max(here, hops) AS here, max(hops) AS hops FROM walk GROUP BY url),
resolved AS (SELECT f.url,
    CASE WHEN f.hops > 30 THEN NULL WHEN coalesce(e.http_code, 200) < 400 THEN f.here END AS url_original,
    CASE WHEN f.hops > 30 THEN 'too_many_redirects' WHEN coalesce(e.http_code, 200) < 400 THEN 'ok' ELSE 'http_error' END AS status,
    CASE WHEN f.hops > 30 THEN NULL ELSE coalesce(e.http_code, 200) END AS http_code
  FROM final f LEFT JOIN edges e ON e.from_url = f.here)"""

@checked(
    "resolve_redirects",
    f"""wanted AS (SELECT from_url AS url FROM edges UNION SELECT to_url FROM edges), {REDIRECT_SQL}
    SELECT url, url_original, status, http_code FROM resolved""",
    ("edges",),
)
def _resolve_redirects(spark, sf):
    edges = view(spark, sf, "edges")
    urls = edges.select(F.col("from_url").alias("url")).unionByName(edges.select(F.col("to_url").alias("url")))
    return resolve_redirects(urls, edges)


# The same walk over the last captures; an error ends a chain without an address.
CAPTURED_SQL = (
    REDIRECT_SQL.replace("edges e", "latest e")
    .replace("CASE WHEN f.hops > 30 THEN NULL WHEN", "CASE WHEN f.hops > 30 OR e.error IS NOT NULL THEN NULL WHEN")
    .replace("THEN 'too_many_redirects' WHEN", "THEN 'too_many_redirects' WHEN e.error IS NOT NULL THEN e.error WHEN")
    .replace("CASE WHEN f.hops > 30 THEN NULL ELSE", "CASE WHEN f.hops > 30 OR e.error IS NOT NULL THEN NULL ELSE")
)


@checked(
    "resolve_redirects_captured",
    f"""latest AS (SELECT DISTINCT from_url, to_url, http_code, error FROM captured_edges WHERE capture = 2),
    wanted AS (SELECT from_url AS url FROM edges UNION SELECT to_url FROM edges), {CAPTURED_SQL}
    SELECT url, url_original, status, http_code FROM resolved""",
    ("edges", "captured_edges"),
)
def _resolve_redirects_captured(spark, sf):
    edges = view(spark, sf, "edges")
    urls = edges.select(F.col("from_url").alias("url")).unionByName(edges.select(F.col("to_url").alias("url")))
    return resolve_redirects(urls, view(spark, sf, "captured_edges"), captured=[F.desc("capture")])


@checked(
    "enrich_urls",
    f"""wanted AS (SELECT doc_id, url FROM visits), {REDIRECT_SQL}
    SELECT w.doc_id, w.url, r.url_original, r.status, r.http_code FROM wanted w LEFT JOIN resolved r ON r.url = w.url""",
    ("edges", "visits"),
)
def _enrich_urls(spark, sf):
    visits = view(spark, sf, "visits")
    resolved = resolve_redirects(visits, view(spark, sf, "edges"))
    return enrich_urls(visits, resolved, spread_by=["doc_id"])


@checked(
    "enrich_urls_copies",
    f"""wanted AS (SELECT doc_id, url FROM visits), {REDIRECT_SQL},
    times AS (SELECT url, count(*) AS copies FROM wanted WHERE url IS NOT NULL GROUP BY url)
    SELECT w.doc_id, w.url, r.url_original, r.status, r.http_code, coalesce(t.copies, 1) AS copies
    FROM wanted w LEFT JOIN resolved r ON r.url = w.url LEFT JOIN times t ON t.url = w.url""",
    ("edges", "visits"),
)
def _enrich_urls_copies(spark, sf):
    visits = view(spark, sf, "visits")
    resolved = resolve_redirects(visits, view(spark, sf, "edges"))
    return enrich_urls(visits, resolved, spread_by=["doc_id"], copies="copies")
