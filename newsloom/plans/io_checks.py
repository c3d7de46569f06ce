"""Checked queries that write a stage table and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import word_count
from newsloom.plans.catalog import checked
from newsloom.plans.views import view
from newsloom.session import scratch_dir
from newsloom.sources import readers, writers

NEWS = ("news",)
TEXT = T.StringType()
KEPT = ["doc_id", "ticker", "headline", "summary", "article_text", "url"]


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else TEXT) for n in names])


@checked(
    "csv_round_trip",
    "SELECT doc_id, ticker, headline, summary, article_text, nullif(url, '') AS url FROM news",
    NEWS,
)
def _csv_round_trip(spark, sf):
    path = scratch_dir(spark, "csv")
    writers.write_csv(view(spark, sf, "news").select(*KEPT), path)
    return readers.read_news_csv(spark, path, _schema(*KEPT))


@checked("jsonl_round_trip", "SELECT * FROM scraped", ("scraped",))
def _jsonl_round_trip(spark, sf):
    scraped = view(spark, sf, "scraped")
    path = scratch_dir(spark, "jsonl")
    writers.write_jsonl(scraped, path)
    return spark.read.schema(scraped.schema).json(path)


@checked(
    "partitioned_round_trip",
    "SELECT doc_id, ticker, headline, article_text, nullif(url, '') AS url FROM news",
    NEWS,
)
def _partitioned_round_trip(spark, sf):
    path = scratch_dir(spark, "by-ticker")
    rows = view(spark, sf, "news").select("doc_id", "headline", "article_text", "url", "ticker")
    writers.write_partitioned(rows, path)
    return readers.read_news_csv(spark, path, rows.schema)


@checked(
    "per_ticker_files",
    "SELECT doc_id, headline, ticker FROM news WHERE ticker IS NOT NULL",
    NEWS,
)
def _per_ticker_files(spark, sf):
    path = scratch_dir(spark, "files")
    rows = view(spark, sf, "news").where(F.col("ticker").isNotNull())
    named = rows.select("doc_id", "headline", F.concat("ticker", F.lit("_orig.csv")).alias("file"))
    writers.write_partitioned(named, path, by="file")
    return readers.read_per_ticker(spark, f"{path}/*_orig.csv", "_orig", _schema("doc_id", "headline"))


@checked(
    "union_files",
    """SELECT doc_id, ticker, headline, NULL::VARCHAR AS summary FROM news WHERE ticker IS NOT NULL
    UNION ALL SELECT doc_id, NULL, headline, summary FROM news WHERE ticker IS NULL""",
    NEWS,
)
def _union_files(spark, sf):
    path = scratch_dir(spark, "union")
    news = view(spark, sf, "news")
    writers.write_csv(news.where(F.col("ticker").isNotNull()).select("doc_id", "ticker", "headline"), f"{path}/a")
    writers.write_csv(news.where(F.col("ticker").isNull()).select("doc_id", "headline", "summary"), f"{path}/b")
    return readers.union_files(
        spark, {f"{path}/a": _schema("doc_id", "ticker", "headline"), f"{path}/b": _schema("doc_id", "headline", "summary")}
    )


# Each row of news becomes an answer of one to three items.
@checked(
    "flatten_company_news",
    # Some epochs have a fraction, and some answers broke off.
    """items AS (SELECT *, unnest(range(0, doc_id % 3 + 1)) AS i FROM news WHERE doc_id % 50 <> 3)
    SELECT 'finnhub' AS provider, ticker,
      strftime(epoch_ms((published_epoch + i) * 1000), '%Y-%m-%dT%H:%M:%S') || CASE WHEN doc_id % 7 = 0 THEN '.500000' ELSE '' END AS published_utc,
      headline, summary, url AS url_redirect, NULL::VARCHAR AS image_url, source, doc_id * 10 + i AS id,
      (published_epoch + i)::DOUBLE + CASE WHEN doc_id % 7 = 0 THEN 0.5 ELSE 0 END AS published_epoch
    FROM items""",
    NEWS,
)
def _flatten_company_news(spark, sf):
    return readers.flatten_company_news(_company_answers(spark, sf))


@checked("unparsed_answers", "SELECT doc_id, ticker FROM news WHERE doc_id % 50 = 3", NEWS)
def _unparsed_answers(spark, sf):
    return readers.unparsed_answers(_company_answers(spark, sf)).select("doc_id", "ticker")


def _company_answers(spark, sf):
    items = F.transform(
        F.sequence(F.lit(0), F.col("doc_id") % 3),
        lambda i: F.struct(
            (F.col("doc_id") * 10 + i).alias("id"),
            (F.col("published_epoch") + i + F.when(F.col("doc_id") % 7 == 0, 0.5).otherwise(0.0)).alias("datetime"),
            "headline",
            "summary",
            "url",
            "source",
        ),
    )
    body = F.to_json(items)
    broken = F.when(F.col("doc_id") % 50 == 3, F.substring(body, 1, 20)).otherwise(body)
    return view(spark, sf, "news").select("doc_id", "ticker", broken.alias("body"))


@checked(
    "flatten_search_response",
    """SELECT CASE WHEN doc_id % 4 <> 0 THEN source END AS source, lang AS author, headline, summary, url AS url_original,
      NULL::VARCHAR AS url_image, published_epoch::VARCHAR AS "publishedAt", article_text AS content_truncated, 'en' AS language
    FROM news WHERE ticker IS NOT NULL AND doc_id % 50 <> 4""",
    NEWS,
)
def _flatten_search_response(spark, sf):
    news = view(spark, sf, "news")
    publisher = F.when(F.col("doc_id") % 4 != 0, F.struct(F.col("source").alias("name")))
    article = F.struct(
        publisher.alias("source"),
        F.col("lang").alias("author"),
        F.col("headline").alias("title"),
        F.col("summary").alias("description"),
        "url",
        F.col("published_epoch").cast("string").alias("publishedAt"),
        F.col("article_text").alias("content"),
    )
    # Some answers have no article, as on a day without news.
    articles = F.when(F.col("ticker").isNotNull(), F.array(article)).otherwise(F.array())
    body = F.to_json(F.struct(F.lit("ok").alias("status"), articles.alias("articles")))
    answers = news.select(F.when(F.col("doc_id") % 50 == 4, "{bad json").otherwise(body).alias("body"))
    return readers.flatten_search_response(answers)


@checked("read_symbols", "SELECT symbol FROM symbols", ("symbols",))
def _read_symbols(spark, sf):
    path = scratch_dir(spark, "symbols")
    writers.write_jsonl(view(spark, sf, "symbols").select("symbol"), path)
    return readers.read_symbols(spark, path)


@checked(
    "read_pages",
    "SELECT url, url AS final_url, status, html, NULL::VARCHAR AS error FROM snapshot",
    ("snapshot",),
)
def _read_pages(spark, sf):
    path = scratch_dir(spark, "pages")
    view(spark, sf, "snapshot").select("url", F.col("url").alias("final_url"), "status", "html").write.parquet(path)
    return readers.read_pages(spark, path)


@checked(
    "append_column_version",
    """SELECT doc_id, headline, coalesce(len(list_filter(regexp_split_to_array(article_text, '\\s+'), lambda w: w <> '')), 0)::INTEGER AS n_words FROM news""",
    NEWS,
)
def _append_column_version(spark, sf):
    base = scratch_dir(spark, "versions")
    first = view(spark, sf, "news").select("doc_id", "headline", "article_text")
    path = writers.append_column_version(first, base, 1)
    stored = spark.read.parquet(path)
    counted = stored.withColumn("n_words", word_count(F.col("article_text")).cast("int"))
    writers.append_column_version(counted, base, 2)
    return writers.latest_version(spark, base).drop("article_text")
