"""Explicit schemas of every stage; nothing is inferred."""

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def _struct(spec: str) -> T.StructType:
    """Columns from "name type, name type, ..."; parsed here, as DDL needs a running session."""
    pairs = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


COMPANY_NEWS_ITEMS = T.ArrayType(_struct(
    "id bigint, datetime double, headline string, summary string, url string, "
    "image string, source string"
))

SEARCH_RESPONSE = T.StructType([
    T.StructField("articles", T.ArrayType(
        T.StructType([T.StructField("source", _struct("name string"))]
                     + _struct("author string, title string, description string, url string, "
                               "urlToImage string, publishedAt string, content string").fields)
    ))
])

SYMBOLS = _struct("symbol string")

PAGES = _struct("url string, final_url string, status int, html string, error string")

CONFORMED = _struct(
    "category string, datetime bigint, headline string, id bigint, image string, related string, "
    "source string, summary string, url string, url_original string, status string, "
    "http_code int, target_url string, domain string, final_url string, http_status int, "
    "article_text string, word_count int"
)

ANALYSIS = _struct(
    "ticker string, headline string, summary string, article_text string, topic string"
)
