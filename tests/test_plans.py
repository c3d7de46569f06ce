"""The shape of the physical plans."""

import datetime as dt
import re

from pyspark.sql import functions as F

from newsloom.operators import backfill, pages, ranking, reports, tfidf, tokens
from newsloom.plans.views import view
from newsloom.session import bucketed, released

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|Single)", plan(df)))


def test_groups_are_cut_before_the_shuffle(spark):
    news = view(spark, SF, "news", dealt=False).select("doc_id", "url", "ticker")
    text = plan(ranking.dedupe(news, ["url"], ["doc_id"]))
    assert re.search(r"WindowGroupLimit \[.*url#.*Final.*Exchange.*WindowGroupLimit \[.*url#.*Partial", text, re.S)
    assert shuffles(ranking.dedupe(news, ["url"], ["doc_id"])) == 1
    assert shuffles(ranking.top_n_per_group(news, ["ticker"], ["doc_id"], 1000)) == 1


def test_tfidf_moves_texts_once(spark):
    news = view(spark, SF, "news", dealt=False).select("doc_id", "article_text")
    terms = tfidf.document_terms(news, "doc_id", "article_text", tfidf.TfidfConfig())
    assert shuffles(terms) == 0 and shuffles(tfidf.term_stats(terms)) == 1
    # Weights and their length per document need no shuffle beyond that.
    model = tfidf.fit_tfidf(news, "doc_id", "article_text")
    text = plan(tfidf.transform_tfidf(model, news))
    assert text.index("Window") < text.index("BroadcastHashJoin")
    before_join = text[: text.index("BroadcastHashJoin")]
    assert "Exchange" not in before_join


def test_bag_of_words_moves_nothing_with_short_tables(spark):
    tables = view(spark, SF, "lexicon", dealt=False), view(spark, SF, "stopwords", dealt=False)
    assert shuffles(tokens.bag_of_words(view(spark, SF, "news", dealt=False), "doc_id", "article_text", *tables)) == 0
    # With long ones the texts move once; the other shuffles reduce the tables to one entry each.
    bag = tokens.bag_of_words(view(spark, SF, "news", dealt=False), "doc_id", "article_text", *tables, inline_rows=0)
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(bag))
    assert keys.count("doc_id") == 1 and set(keys) <= {"doc_id", "form", "word"}


def test_bucketed_tables_join_without_a_shuffle(spark):
    a = bucketed(spark.range(1000).withColumn("x", F.col("id") * 2), "id", "a", 4)
    b = bucketed(spark.range(1000).withColumn("y", F.col("id") * 3), "id", "b", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "id")
        assert shuffles(joined) == 0 and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    released(a), released(b)


def test_days_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "news")
    days = spark.range(2000).select(F.col("id"), F.lit("T").alias("ticker"), F.date_sub(F.lit("2025-02-05").cast("date"), F.col("id").cast("int")).alias("day"), F.concat(F.lit("u"), "id").alias("url"))
    days.write.parquet(path)
    got = backfill.backfill(spark.read.parquet(path), dt.date(2025, 2, 5), [F.desc("day")])
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(day,2024-01-30", plan(got))
    assert got.count() == 50


def test_only_wanted_pages_are_read_further(spark):
    leads, web = view(spark, SF, "leads", dealt=False), view(spark, SF, "web", dealt=False)
    text = plan(pages.scrape(leads, web, ["doc_id"], captured=[F.desc("page_id")]))
    assert "LeftSemi" in text and text.index("extractor_used") < text.index("LeftSemi")
    named = pages.wanted_pages(web, leads, F.col("url_original"), [F.desc("page_id")])
    wanted = {r.url for r in named.select("url").collect()}
    known = {r.url for r in web.select("url").collect()}
    assert wanted == known & {(r.url_original or "").strip() for r in leads.select("url_original").collect()}


def test_scans_read_only_what_is_needed(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    gated = reports.quality_gate(documents.where(F.col("lang") == "en"), "text", 100, "strict").select("doc_id")
    text = plan(gated)
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text
    assert "EqualTo(lang,en)" in text
    assert "Exchange" not in text


def test_only_small_tables_are_dealt_out(spark, tmp_path):
    from newsloom import session

    one = spark.range(1000).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    table = spark.read.parquet(str(tmp_path / "one"))
    dealt = session.spread(table, "id")
    rows = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(rows) > 4 and sum(rows) == 1000 and max(rows) < 400
    assert session.spread(spark.range(1 << 40), "id").rdd.getNumPartitions() == spark.range(1 << 40).rdd.getNumPartitions()
    assert "Exchange" not in session.spread(spark.range(1 << 40), "id")._jdf.queryExecution().executedPlan().toString()
