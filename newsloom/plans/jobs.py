"""Whole jobs, from stage tables to stage tables; each is one lazy plan up to its sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import search
from newsloom.operators.backfill import (
    FIXED_TARGET,
    FIXED_TICKERS,
    SAMPLED_TARGET,
    backfill,
    build_index,
    precedence_of,
    sample_symbols,
)
from newsloom.operators.conform import conform_article
from newsloom.operators.pages import extract_main_text, resolve_canonical, scrape
from newsloom.operators.ranking import dedupe_chain


def corpus_index(collected: DataFrame, order_by: list) -> DataFrame:
    """One row per address of the collected articles; fixed tickers come first, in their order."""
    placed = collected.withColumn("place", precedence_of(F.col("ticker"), FIXED_TICKERS))
    return build_index([placed], "url", ["place", "window_no", *order_by]).drop("place")


def ticker_corpus(
    news: DataFrame,
    symbols: DataFrame,
    pages: DataFrame,
    suffixes: DataFrame,
    as_of: dt.date,
    order_by: list,
    row_id: str,
) -> DataFrame:
    """Backfill per ticker, index, original address and article text of good quality.

    `news` has row_id, ticker, day and url; `pages` one capture per address.
    """
    spark = news.sparkSession
    fixed = spark.createDataFrame([(t,) for t in FIXED_TICKERS], "ticker string")
    sampled = sample_symbols(symbols).select(F.col("symbol").alias("ticker"))
    # At most the fixed and the sampled number of tickers, so the broadcast is bounded.
    wanted = news.join(F.broadcast(fixed.unionByName(sampled)), "ticker", "left_semi")
    collected = backfill(
        wanted,
        as_of,
        order_by,
        default_target=SAMPLED_TARGET,
        targets={t: FIXED_TARGET for t in FIXED_TICKERS},
        row_id=row_id,
    )
    index = corpus_index(collected, order_by)
    resolved = resolve_canonical(index, pages, suffixes, [row_id], url="url").drop("error")
    return extract_main_text(resolved, pages, [row_id], url="url_final")


def search_corpus(
    articles: DataFrame,
    text_cols: list[str],
    url: str,
    as_of: dt.date,
    days: int = 30,
    language: tuple[str, str] | None = ("language", "en"),
    published: str = "publishedAt",
    row_id: str = "id",
    per_day: int = 100,
    include: tuple[str, ...] = search.FINANCE_DOMAINS,
    exclude: tuple[str, ...] = search.EXCLUDED_DOMAINS,
) -> DataFrame:
    """Recent finance articles: the newest of each day, one per address, then one per headline.

    `articles` has a date column `day`. Rows keep the order of the daily answers, oldest
    day first, when the first of several is kept.
    """
    dated = search.recent(articles, "day", as_of, days, language)
    hits = search.keyword_search(search.domain_filter(dated, url, include, exclude), text_cols)
    daily = search.top_per_day(hits, "day", [F.desc(published), row_id], per_day)
    return dedupe_chain(daily, [url], ["headline"], order_by=["day", F.desc(published), row_id])


def scraped_corpus(found: DataFrame, pages: DataFrame, row_id: str, order_by: list) -> DataFrame:
    """Search results with their article text, in the 18-column schema."""
    return conform_article(scrape(found, pages, [row_id]), order_by)
