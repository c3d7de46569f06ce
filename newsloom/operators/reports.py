"""Counts and shares for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.quality import is_good_text


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    if dropna:
        df = df.where(F.col(col).isNotNull())
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


def top_values(df: DataFrame, col: str, n: int, dropna: bool = True) -> DataFrame:
    return value_counts(df, col, dropna).limit(n)


def top_tickers(df: DataFrame, n: int = 20) -> DataFrame:
    """The most frequent tickers, in ascending order for a bar chart."""
    return top_values(df, "ticker", n).orderBy("n", F.desc("ticker"))


def share(df: DataFrame, col: str) -> DataFrame:
    """Percent of the non-null rows that have each value, one decimal."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / total, 1)).orderBy(F.desc("n"), col)


def stage_counts(df: DataFrame, distinct: list[str]) -> DataFrame:
    """Number of rows, and of distinct non-null values of each named column."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct],
    )


def quality_gate(df: DataFrame, col: str, min_len: int = 100, artefacts: str = "basic") -> DataFrame:
    """Rows whose text is long enough and free of extraction artefacts."""
    return df.where(is_good_text(F.col(col), min_len, artefacts))


def quality_report(
    df: DataFrame, col: str, by: str | None = None, min_len: int = 100, artefacts: str = "basic"
) -> DataFrame:
    """Rows before, after and dropped by the quality gate, overall or per group, in one pass."""
    good = F.coalesce(is_good_text(F.col(col), min_len, artefacts), F.lit(False))
    return df.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(good).alias("rows_after"),
        F.count_if(~good).alias("rows_dropped"),
    )
