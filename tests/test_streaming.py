"""Column functions and filters on a streaming DataFrame give the rows of the batch."""

from pyspark.sql import functions as F

from newsloom.functions.text import light_clean, normalize_finance
from newsloom.functions.urls import normalized_domain
from newsloom.operators.reports import quality_gate
from newsloom.operators.search import keyword_search
from newsloom.plans.views import view


def cleaned(news):
    hits = keyword_search(quality_gate(news, "article_text", 100, "strict"), ["summary", "article_text"])
    return hits.select(
        "doc_id",
        normalized_domain(F.col("url")).alias("domain"),
        light_clean(F.col("article_text")).alias("cleaned"),
        normalize_finance(F.col("article_text")).alias("normal"),
    )


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "landed")
    view(spark, "/root/testdata/sf0.001", "news").repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = (
        cleaned(stream).writeStream.format("memory").queryName("landed_news")
        .option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {tuple(r) for r in spark.table("landed_news").collect()}
    assert got == {tuple(r) for r in cleaned(stored).collect()} and got
