"""Stage inputs with explicit schemas."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.dates import iso_from_epoch
from newsloom.operators.backfill import union_all
from newsloom.schemas import COMPANY_NEWS_ITEMS, PAGES, SEARCH_RESPONSE, SYMBOLS

# ---- fixed value: provider written for company news ----
PROVIDER = "finnhub"


def _empty_to_null(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def read_news_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted multi-line texts; empty fields are null.

    A quoted line break rules out splitting a file, so a file is a task: write many of
    moderate size, as `write_csv` does.
    """
    reader = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"')
    return _empty_to_null(reader.csv(path))


def read_per_ticker(
    spark: SparkSession, pattern: str, suffix: str, schema: T.StructType, name: str = "ticker"
) -> DataFrame:
    """One scan of many per-ticker files or folders, named `<ticker><suffix>...`.

    A folder of Spark's own partitioned writing (`column=<ticker><suffix>...`) will do too.
    """
    reader = spark.read.schema(schema).options(header=True, multiLine=True, quote='"', escape='"')
    path = F.col("_metadata.file_path")
    ticker = F.regexp_extract(path, rf"([^/=]+?){re.escape(suffix)}[^/]*(?:/[^/]*)?$", 1)
    return _empty_to_null(reader.csv(pattern).select("*", F.url_decode(ticker).alias(name)))


def union_files(spark: SparkSession, paths: dict[str, T.StructType]) -> DataFrame:
    """Files of differing columns, matched by name; missing columns are null."""
    return union_all([read_news_csv(spark, p, s) for p, s in paths.items()]).drop("precedence")


def _parsed(df: DataFrame, body: str, schema: T.DataType, root: str, mode: str) -> DataFrame:
    """`df` with `parsed_body`, by the answer's JSON; bodies that are none, or of another kind, are dropped or fail."""
    if mode not in ("drop", "fail"):
        raise ValueError(f"mode must be 'drop' or 'fail', not {mode!r}")
    good = _is_answer(F.col(body), root)
    if mode == "fail":
        wrong = F.raise_error(F.concat(F.lit("not an answer: "), F.coalesce(F.substring(body, 1, 200), F.lit("null"))))
        return df.withColumn("parsed_body", F.when(good, F.from_json(F.col(body), schema)).otherwise(F.from_json(wrong, schema)))
    return df.where(good).withColumn("parsed_body", F.from_json(F.col(body), schema))


def _is_answer(body: Column, root: str) -> Column:
    """Whether a body is whole JSON whose root is of the kind that answers have."""
    whole = F.try_parse_json(body)
    return F.coalesce(F.startswith(F.schema_of_variant(whole), F.lit(root)), F.lit(False))


def unparsed_answers(df: DataFrame, body: str = "body", root: str = "ARRAY") -> DataFrame:
    """The rows whose body is no answer: no JSON, or not an `ARRAY` (company news) or `OBJECT` (search)."""
    return df.where(~_is_answer(F.col(body), root))


def flatten_company_news(df: DataFrame, body: str = "body", ticker: str = "ticker", mode: str = "drop") -> DataFrame:
    """One row per item of the JSON array in `body`, in the eight company-news columns.

    Also keeps the item's id and epoch, which order the articles. Bodies that are no JSON array fail the job
    with `mode="fail"`; else they give no rows, and `unparsed_answers` lists them.
    """
    parsed = _parsed(df, body, COMPANY_NEWS_ITEMS, "ARRAY", mode)
    items = parsed.select(F.col(ticker).alias("ticker"), F.explode("parsed_body").alias("a"))
    return items.select(
        F.lit(PROVIDER).alias("provider"),
        "ticker",
        iso_from_epoch(F.col("a.datetime")).alias("published_utc"),
        "a.headline",
        "a.summary",
        F.col("a.url").alias("url_redirect"),
        F.col("a.image").alias("image_url"),
        "a.source",
        F.col("a.id").alias("id"),
        F.col("a.datetime").alias("published_epoch"),
    )


def flatten_search_response(df: DataFrame, body: str = "body", language: str = "en", mode: str = "drop") -> DataFrame:
    """One row per article of a search response, with the search table's column names.

    Bodies that are no JSON object fail the job with `mode="fail"`; else they give no rows, and
    `unparsed_answers(root="OBJECT")` lists them.
    """
    parsed = _parsed(df, body, SEARCH_RESPONSE, "OBJECT", mode)
    articles = parsed.select(F.explode("parsed_body.articles").alias("a")).where(F.col("a").isNotNull())

    def renamed(field: str, name: str) -> Column:
        return F.col(f"a.{field}").alias(name)

    return articles.select(
        renamed("source.name", "source"),
        renamed("author", "author"),
        renamed("title", "headline"),
        renamed("description", "summary"),
        renamed("url", "url_original"),
        renamed("urlToImage", "url_image"),
        renamed("publishedAt", "publishedAt"),
        renamed("content", "content_truncated"),
        F.lit(language).alias("language"),
    )


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbol master listing, JSON lines."""
    return spark.read.schema(SYMBOLS).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages: url, final_url, status, html, error."""
    return spark.read.schema(PAGES).parquet(path)
