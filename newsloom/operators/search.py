"""Search over captured articles: keywords, domains, language, dates."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import any_of, let
from newsloom.functions.urls import host
from newsloom.operators.ranking import top_n_per_group

# ---- fixed values: the finance query ----
FINANCE_TERMS = (
    "bankruptcy", "insolvency", "files for bankruptcy", "chapter 11",
    "stock plunges", "shares fall", "stock drops", "shares drop",
    "downgrade", "profit warning", "layoffs", "restructuring",
    "merger", "acquisition", "takeover", "IPO", "initial public offering",
    "earnings report", "quarterly results", "financial results",
    "appoints CEO", "resigns CEO", "chief executive", "steps down",
    "restructuring plan", "cut jobs", "mass layoffs",
)

# ---- fixed values: searched and excluded publishers ----
FINANCE_DOMAINS = (
    "bloomberg.com", "reuters.com", "ft.com", "wsj.com", "cnbc.com", "marketwatch.com",
    "businessinsider.com", "forbes.com", "seekingalpha.com", "barrons.com",
    "investing.com", "finance.yahoo.com",
)
EXCLUDED_DOMAINS = ("sports.yahoo.com", "autos.yahoo.com")


def matches_terms(c: Column, terms: tuple[str, ...] = FINANCE_TERMS) -> Column:
    """Whether any term occurs as whole words, whatever the case."""
    lowered = [t.lower() for t in terms]
    choice = "|".join(re.escape(t).replace(r"\ ", r"\s+") for t in lowered)
    first_words = sorted({t.split()[0] for t in lowered})

    def found(low: Column) -> Column:
        # Most texts lack the first word of every term, which is quick to see.
        return any_of([F.contains(low, F.lit(w)) for w in first_words]) & low.rlike(rf"(?U)\b(?:{choice})\b")

    return F.coalesce(let(F.lower(c), found), F.lit(False))


def keyword_search(
    df: DataFrame, cols: list[str], terms: tuple[str, ...] = FINANCE_TERMS
) -> DataFrame:
    """Rows with at least one of the terms in at least one of the columns."""
    return df.where(any_of([matches_terms(F.col(c), terms) for c in cols]))


def under_domain(hosts: Column, domains: tuple[str, ...]) -> Column:
    return any_of([(hosts == d) | hosts.endswith("." + d) for d in domains])


def domain_filter(
    df: DataFrame,
    url: str,
    include: tuple[str, ...] = FINANCE_DOMAINS,
    exclude: tuple[str, ...] = EXCLUDED_DOMAINS,
) -> DataFrame:
    """Rows whose host is, or is below, an included domain and no excluded one."""
    where = host(F.col(url))
    keep = under_domain(where, include) if include else F.lit(True)
    if exclude:
        keep = keep & ~under_domain(where, exclude)
    return df.where(keep)


def recent(
    df: DataFrame,
    day: str,
    as_of: dt.date,
    days: int,
    language: tuple[str, str] | None = None,
    tickers: list[str] | None = None,
) -> DataFrame:
    """Rows of the last `days` days up to and with `as_of`; language is (column, value)."""
    df = df.where(F.col(day).between(F.lit(as_of - dt.timedelta(days=days)), F.lit(as_of)))
    if language:
        df = df.where(F.col(language[0]) == language[1])
    if tickers:
        df = df.where(F.col("ticker").isin(*tickers))
    return df


def top_per_day(df: DataFrame, day: str, order_by: list, n: int = 100) -> DataFrame:
    """The first `n` rows of every day."""
    return top_n_per_group(df, [day], order_by, n)
