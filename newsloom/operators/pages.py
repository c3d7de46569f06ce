"""Work on captured pages: canonical addresses, article text, the scrape job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.html import extract_best, extract_canonical, whole_text
from newsloom.functions.quality import CONSENT_WINDOW, fetch_error, is_good_text
from newsloom.functions.text import light_clean, strip, text_length
from newsloom.functions.urls import (
    choose_original,
    host,
    is_blacklisted,
    is_http_url,
    registered_domain,
)
from newsloom.operators.joins import is_small, lookup_join, skew_join
from newsloom.operators.ranking import dedupe
from newsloom.session import stored

# ---- fixed values: names a URL column may have, in order of preference ----
URL_COLUMNS = ("url_redirect", "url", "link")
ERROR_CHARS = 200
INLINE_RULES = 20_000


def pick_url_column(df: DataFrame) -> str:
    """A column with a known name, else the first text column with a web address in it."""
    for name in URL_COLUMNS:
        if name in df.columns:
            return name
    texts = [name for name, kind in df.dtypes if kind == "string"]
    if texts:
        seen = df.agg(*[F.max(is_http_url(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(texts)]).first()
        for i, name in enumerate(texts):
            if seen[i]:
                return name
    raise ValueError("no column holds web addresses")


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def last_captures(pages: DataFrame, captured: list | None = None) -> DataFrame:
    """One row per address: the first in the order `captured`, and of those alike the first by content."""
    by_content = [c for c in ("status", "html", "final_url", "error") if c in pages.columns]
    return dedupe(pages, ["url"], [*(captured or []), *by_content], nulls="drop")


def wanted_pages(pages: DataFrame, df: DataFrame, url: Column, captured: list | None = None) -> DataFrame:
    """The last captures of the addresses in column `url` of `df`, so that no other page is read further.

    The distinct addresses are broadcast if they were measured to be few; else both sides are
    placed by address, which keep-first then finds done.
    """
    keys = stored(df.select(strip(url).alias("url")).where(F.col("url").isNotNull()).distinct(), "wanted")
    keys = F.broadcast(keys) if is_small(keys) else keys
    return last_captures(pages.join(keys, "url", "left_semi"), captured)


def extract_pages(pages: DataFrame, consent_chars: int | None = CONSENT_WINDOW) -> DataFrame:
    """Text and fetch outcome of each captured page: url, final_url, status, error, text, tier.

    Runs once per page, before any join, so an address shared by many articles costs once.
    """
    retry = F.col("retry_html") if "retry_html" in pages.columns else None
    best = extract_best(F.col("status"), F.col("html"), retry)
    return pages.select(
        "url",
        F.coalesce(_optional(pages, "final_url"), F.col("url")).alias("final_url"),
        "status",
        fetch_error(F.col("url"), F.col("status"), F.col("html"), _optional(pages, "error"), consent_chars).alias("error"),
        best.alias("best"),
    ).select(
        "url", "final_url", "status", "error",
        light_clean(F.col("best.text")).alias("full_text"),
        F.col("best.tier").alias("extractor_used"),
    )


def attach_pages(df: DataFrame, pages: DataFrame, url: str, spread_by: list[str]) -> DataFrame:
    """Left join with one row per captured address (the columns of `pages`), by trimmed url."""
    keyed = df.withColumn("page_key", strip(F.col(url)))
    right = pages.withColumnRenamed("url", "page_key")
    return skew_join(keyed, right, ["page_key"], spread_by=spread_by).drop("page_key")


def scrape(
    df: DataFrame,
    pages: DataFrame,
    spread_by: list[str],
    url: str = "url_original",
    captured: list | None = None,
    consent_chars: int | None = CONSENT_WINDOW,
) -> DataFrame:
    """Add full_text, extractor_used, status, error, final_url, text_length to articles.

    Invalid and blacklisted addresses are settled without a look at the pages, and only pages that
    an article names are read. Of repeated captures the first in the order `captured` counts.
    """
    address = F.col(url)
    valid = is_http_url(address) & ~F.coalesce(is_blacklisted(address), F.lit(False))
    wanted = df.withColumn("wanted_url", F.when(valid, address))
    named = wanted_pages(pages, wanted, F.col("wanted_url"), captured)
    found = attach_pages(wanted, extract_pages(named, consent_chars), "wanted_url", spread_by)
    why = (
        F.when(~is_http_url(address), "invalid_url")
        .when(~valid, "blacklisted_domain")
        .when(F.col("final_url").isNull(), "fetch_error:NotCaptured:no page captured")
        .otherwise(F.col("error"))
    )
    return found.select(
        *df.columns,
        "full_text",
        "extractor_used",
        F.when(valid, F.coalesce("status", F.lit(0))).cast("int").alias("status"),
        why.alias("error"),
        F.when(valid, F.coalesce("final_url", address)).alias("final_url"),
        text_length(F.col("full_text")).alias("text_length"),
    )


def extract_main_text(
    df: DataFrame, pages: DataFrame, spread_by: list[str], url: str = "url_original", captured: list | None = None
) -> DataFrame:
    """Add article_text, the page's whole text, and keep rows where it passes the strict gate.

    Only pages that a row names are read, each in the first capture of the order `captured`.
    """
    # A filter on a computed text would compute it again for each use; here it is computed
    # once, and a page without a good text gives no row.
    good = F.filter(
        F.array(whole_text(F.col("html"))), lambda text: is_good_text(text, 100, "strict")
    )
    named = wanted_pages(pages, df, F.col(url), captured)
    texts = named.where(F.col("status") == 200).select("url", F.explode(good).alias("article_text"))
    return attach_pages(df, texts, url, spread_by).where(F.col("article_text").isNotNull())


def registered_domains(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """host and domain (name plus public suffix) of the distinct hosts of column `url`.

    `suffixes` has one rule per row in column `suffix`: "co.uk", "*.ck" for any one label,
    "!www.ck" for an exception. The longest rule wins; without one the last label stands.
    """
    hosts = urls.select(host(F.col("url")).alias("host")).where(F.col("host") != "").distinct()
    labels = F.split("host", r"\.")
    placed = hosts.withColumn("labels", labels).select(
        "host", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("start")
    )

    def tail(start: Column) -> Column:
        return F.array_join(F.slice("labels", start, F.size("labels")), ".")

    start = F.col("start")
    forms = F.array(
        F.struct(tail(start).alias("suffix"), start.alias("cut")),
        F.struct(F.concat(F.lit("*."), tail(start + 1)).alias("suffix"), start.alias("cut")),
        F.struct(F.concat(F.lit("!"), tail(start)).alias("suffix"), (start + 1).alias("cut")),
    )
    candidates = placed.select("host", "labels", F.explode(forms).alias("form")).select(
        "host", "labels", "form.suffix", "form.cut"
    )
    # An exception rule outranks the wildcard it excepts from; otherwise the longest wins.
    rules = suffixes.select("suffix").distinct()
    exception = F.col("suffix").startswith("!")
    matched = lookup_join(candidates, rules, ["suffix"], ["host"], "inner").groupBy("host").agg(
        F.min_by("cut", F.struct(F.when(exception, 0).otherwise(1), F.col("cut"))).alias("cut")
    )
    return placed.where(start == 1).join(matched, "host", "left").select(
        "host",
        F.when(F.col("cut").isNull(), F.element_at("labels", -1))
        .otherwise(
            F.concat_ws(
                ".",
                F.coalesce(F.get("labels", F.col("cut") - 2), F.lit("")),
                tail(F.col("cut")),
            )
        )
        .alias("domain"),
    )


def with_registered_domain(
    df: DataFrame,
    url: str,
    suffixes: DataFrame,
    spread_by: list[str],
    name: str = "domain",
    inline_rules: int = INLINE_RULES,
) -> DataFrame:
    """Add the registered domain of a url column; '' where there is no host.

    A list of suffixes of the usual size is applied inside the row; a longer one is joined
    to the distinct hosts.
    """
    suffixes = suffixes.select("suffix").where(F.col("suffix").isNotNull()).distinct()
    rules = suffixes.limit(inline_rules + 1).collect()
    if len(rules) <= inline_rules:
        return df.withColumn(name, registered_domain(F.col(url), sorted(r["suffix"] for r in rules)))
    known = registered_domains(df.select(F.col(url).alias("url")), suffixes).withColumnRenamed("domain", name)
    keyed = df.withColumn("host", F.nullif(host(F.col(url)), F.lit("")))
    return (
        skew_join(keyed, known, ["host"], spread_by=spread_by)
        .withColumn(name, F.coalesce(name, F.lit("")))
        .drop("host")
    )


def resolve_canonical(
    df: DataFrame,
    pages: DataFrame,
    suffixes: DataFrame,
    spread_by: list[str],
    url: str | None = None,
    captured: list | None = None,
    error_chars: int | None = ERROR_CHARS,
) -> DataFrame:
    """Add url_final, url_canonical, url_original, domain, http_status and error.

    A page is read for its canonical address unless its status is an error (400 or more);
    its final address counts either way. Only pages that a row names are read, each in the first
    capture of the order `captured`. Errors are cut to `error_chars` characters (None: whole).
    """
    column = url or pick_url_column(df)
    address = strip(F.col(column))
    valid = is_http_url(address)
    base = df.withColumn("wanted_url", F.when(valid, address))
    pages = wanted_pages(pages, base, F.col("wanted_url"), captured)
    answered = F.col("status") != 0
    readable = F.col("status").between(200, 399)
    final = F.coalesce(_optional(pages, "final_url"), F.col("url"))
    failure = F.coalesce(_optional(pages, "error"), F.lit("no response captured"))
    outcome = pages.select(
        "url",
        F.when(answered, final).alias("url_final"),
        F.when(readable, extract_canonical(F.col("html"), final)).alias("url_canonical"),
        F.when(answered, F.col("status")).cast("int").alias("http_status"),
        F.when(~answered, failure if error_chars is None else F.substring(failure, 1, error_chars)).alias("error"),
    ).withColumn("url_original", choose_original(F.col("url_final"), F.col("url_canonical")))
    outcome = with_registered_domain(outcome, "url_original", suffixes, spread_by=["url"])

    found = attach_pages(base, outcome, "wanted_url", spread_by)
    why = (
        F.when(~valid, "no_url")
        .when(F.col("url_final").isNotNull(), "")
        .otherwise(F.coalesce("error", F.lit("fetch_failed")))
    )
    return found.select(
        *df.columns,
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("url_final", "url_canonical", "url_original", "domain")],
        "http_status",
        why.alias("error"),
    )

