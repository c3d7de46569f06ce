"""Shaping rows: column choice, defaults, the 18-column article schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.dates import to_unix
from newsloom.functions.quality import derive_http_code
from newsloom.functions.text import is_blank, word_count
from newsloom.functions.urls import normalized_domain
from newsloom.operators.ranking import with_sequential_id
from newsloom.schemas import ANALYSIS, CONFORMED

# ---- fixed values: columns whose nulls become '' ----
BLANKED = (
    "category", "headline", "image", "related", "source", "summary", "url", "url_original",
    "target_url", "domain", "final_url", "article_text", "status",
)


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows without a null in any of the columns."""
    return df.na.drop(how="any", subset=cols)


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither null nor only white space."""
    return df.where(~is_blank(F.col(col)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order and types; missing ones are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def blank_nulls(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """The columns as text, '' for null."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols})


def col_or(df: DataFrame, name: str, default: object = "") -> Column:
    """A column, or a default where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(default)


def analysis_columns(df: DataFrame) -> DataFrame:
    """The analysis columns of the rows that have a text and a headline."""
    return drop_null(conform(df, ANALYSIS), ["article_text", "headline"])


def conform_article(df: DataFrame, order_by: list, category: str = "finance") -> DataFrame:
    """Scraped articles in the 18-column schema, numbered in the given order."""
    numeric_error = "error" in df.columns and isinstance(df.schema["error"].dataType, T.NumericType)
    error, status = col_or(df, "error", None), col_or(df, "status", None)
    final = F.coalesce(F.col("final_url"), F.col("url_original"))
    code = derive_http_code(error.cast("string"), status.try_cast("int"), F.col("full_text"))
    if numeric_error:
        code = F.coalesce(error.try_cast("int"), code)
    text = F.coalesce(F.col("full_text"), col_or(df, "content_truncated", None))
    numbered = with_sequential_id(df, order_by)
    shaped = numbered.select(
        F.lit(category).alias("category"),
        to_unix(F.col("publishedAt")).alias("datetime"),
        col_or(df, "headline").alias("headline"),
        F.col("id"),
        col_or(df, "url_image").alias("image"),
        F.lit("").alias("related"),
        col_or(df, "source").alias("source"),
        col_or(df, "summary").alias("summary"),
        final.alias("url"),
        F.col("url_original"),
        status.alias("status"),
        code.alias("http_code"),
        final.alias("target_url"),
        normalized_domain(F.when(final != "", final).otherwise(F.col("url_original"))).alias("domain"),
        final.alias("final_url"),
        code.alias("http_status"),
        text.alias("article_text"),
        word_count(text).alias("word_count"),
    )
    return blank_nulls(conform(shaped, CONFORMED), BLANKED)
