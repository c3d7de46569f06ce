"""Collecting a target number of articles per ticker, newest windows first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.joins import skew_join
from newsloom.operators.ranking import dedupe, top_n_per_group

# ---- fixed values: the tickers always collected, and how much of each kind ----
FIXED_TICKERS = ("AAPL", "MSFT", "TSLA", "META", "GOOGL", "NVDA", "AMZN")
FIXED_TARGET = 1000
SAMPLED_TARGET = 50
SAMPLED_TICKERS = 100
SAMPLE_SEED = 42
WINDOW_DAYS = 7
LOOKBACK_DAYS = 365

DAY_SECONDS = 86_400


def last_window(window_days: int, lookback_days: int) -> int:
    """Number of the last window whose end lies inside the lookback.

    Each window ends one second before the one before it starts.
    """
    return -(-lookback_days * DAY_SECONDS // (window_days * DAY_SECONDS + 1)) - 1


def windows_of(days_ago: Column, window_days: int, last: int) -> Column:
    """Numbers of the windows that hold a day; neighbours share one day from window 1 on."""
    first = F.greatest(F.lit(1), F.ceil((days_ago - window_days - 1) / window_days))
    final = F.least(F.lit(last), F.floor((days_ago - 1) / window_days))
    return (
        F.when(days_ago.between(0, window_days), F.array(F.lit(0).cast("bigint")))
        .when((days_ago > window_days) & (first <= final), F.sequence(first.cast("bigint"), final.cast("bigint")))
        .otherwise(F.array().cast("array<bigint>"))
    )


def with_target(df: DataFrame, targets: DataFrame | Mapping[str, int] | None, default: int) -> DataFrame:
    """Add each ticker's target; `targets` (ticker, target) may be a table or a short mapping."""
    if targets is None or (isinstance(targets, Mapping) and not targets):
        return df.withColumn("target", F.lit(default))
    if isinstance(targets, Mapping):
        targets = df.sparkSession.createDataFrame(list(targets.items()), "ticker string, target int")
    one = targets.where(F.col("ticker").isNotNull()).groupBy("ticker").agg(F.max("target").alias("target"))
    return df.join(one, "ticker", "left").withColumn("target", F.coalesce("target", F.lit(default)))


def backfill(
    news: DataFrame,
    as_of: dt.date,
    order_by: list,
    default_target: int = SAMPLED_TARGET,
    targets: DataFrame | Mapping[str, int] | None = None,
    window_days: int = WINDOW_DAYS,
    lookback_days: int = LOOKBACK_DAYS,
    row_id: str = "id",
) -> DataFrame:
    """Walk windows back from `as_of` until a ticker has its target, then dedupe and cut.

    `targets` (ticker, target) names targets other than the default. Only days that some window
    holds are read. A window is read if the raw rows of the windows before it are fewer than the target; a
    row in two windows counts in both. `news` has columns ticker, day, url and `row_id`;
    the result gains `window_no`, the first window an article was seen in.
    """
    last = last_window(window_days, lookback_days)
    days_ago = F.date_diff(F.lit(as_of), F.col("day"))
    oldest = as_of - dt.timedelta(days=lookback_days + window_days)
    inside = F.col("ticker").isNotNull() & F.col("day").between(F.lit(oldest), F.lit(as_of))
    placed = news.where(inside).withColumn("window_no", F.explode(windows_of(days_ago, window_days, last)))

    # At most one row per ticker and window is left after the map-side count.
    sizes = placed.groupBy("ticker", "window_no").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("ticker").orderBy("window_no").rowsBetween(Window.unboundedPreceding, -1)
    read = with_target(
        sizes.withColumn("seen", F.coalesce(F.sum("size").over(before), F.lit(0))), targets, default_target
    ).where(F.col("seen") < F.col("target"))
    reach = read.groupBy("ticker").agg(F.max("window_no").alias("reach"), F.max("target").alias("target"))

    rows = skew_join(placed, reach, ["ticker"], spread_by=[row_id, "window_no"], how="inner")
    rows = rows.where(F.col("window_no") <= F.col("reach")).drop("reach")
    order = ["window_no", *order_by]
    unique = dedupe(rows.where(F.col("url").isNotNull() & (F.col("url") != "")), ["ticker", "url"], order)

    if targets is None:
        return top_n_per_group(unique, ["ticker"], order, default_target).drop("target")
    # A hot ticker is cut to the largest target before its own place is looked at.
    named = targets.values() if isinstance(targets, Mapping) else [targets.agg(F.max("target")).first()[0] or 0]
    ranked = top_n_per_group(unique, ["ticker"], order, max([default_target, *named]))
    place = F.row_number().over(Window.partitionBy("ticker").orderBy(*order))
    return ranked.withColumn("place", place).where(F.col("place") <= F.col("target")).drop("place", "target")


def is_symbol(c: Column) -> Column:
    """Non-empty, upper case with at least one letter, at most six characters."""
    return c.isNotNull() & (c != "") & (F.upper(c) == c) & (F.lower(c) != c) & (F.length(c) <= 6)


def valid_symbols(df: DataFrame) -> DataFrame:
    return df.where(is_symbol(F.col("symbol")))


def sample_symbols(
    df: DataFrame,
    n: int = SAMPLED_TICKERS,
    exclude: tuple[str, ...] = FIXED_TICKERS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """`n` distinct valid symbols outside `exclude`, in an order set by the seed alone."""
    pool = valid_symbols(df).select("symbol").distinct().where(~F.col("symbol").isin(*exclude))
    draw = F.md5(F.concat(F.col("symbol"), F.lit(f"#{seed}")))
    return pool.orderBy(draw, "symbol").limit(n)


def precedence_of(ticker: Column, tickers: tuple[str, ...]) -> Column:
    """A ticker's place in a list, from 1; the tickers not listed share the last place."""
    place = F.array_position(F.array(*[F.lit(t) for t in tickers]), ticker)
    return F.when(place > 0, place).otherwise(F.lit(len(tickers) + 1))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name; `precedence` is the part's place."""
    result = parts[0].withColumn("precedence", F.lit(0))
    for place, part in enumerate(parts[1:], 1):
        result = result.unionByName(
            part.withColumn("precedence", F.lit(place)), allowMissingColumns=True
        )
    return result


def build_index(parts: list[DataFrame], url: str, order_by: list) -> DataFrame:
    """Union of the parts with one row per address: that of the earliest part and order."""
    return dedupe(union_all(parts), [url], ["precedence", *order_by]).drop("precedence")
