"""Operators against brute force on small tables, hot keys included."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import backfill as bf
from newsloom.operators import conform as cf
from newsloom.operators import pages as pg
from newsloom.operators import ranking, redirects, reports, search, tfidf, tokens, topics
from newsloom.operators.joins import skew_join
from newsloom.operators.lines import clean_lines


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=str)


# ---------------------------------------------------------------- ranking


def test_dedupe_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "")], "id int, k string")
    assert rows(ranking.dedupe(df, ["k"], ["id"]), "id") == [(1,), (3,), (5,)]
    assert rows(ranking.dedupe(df, ["k"], [F.desc("id")], nulls="drop"), "id") == [(2,)]
    with pytest.raises(ValueError):
        ranking.dedupe(df, ["k"], ["id"], nulls="?")


def test_dedupe_chain_order_matters(spark):
    data = [(1, "u1", "h1"), (2, "u1", "h2"), (3, "u2", "h2"), (4, "u3", "h1")]
    df = spark.createDataFrame(data, "id int, url string, headline string")
    # Row 2 goes with its url, so it cannot take h2 from row 3.
    assert rows(ranking.dedupe_chain(df, ["url"], ["headline"], order_by=["id"]), "id") == [(1,), (3,)]
    assert rows(ranking.dedupe_chain(df, ["headline"], ["url"], order_by=["id"]), "id") == [(1,)]


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n_per_group_with_a_hot_group(spark, n):
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 else f"k{i % 50}", rng.random()) for i in range(9000)]
    df = spark.createDataFrame(data, "id int, k string, v double").repartition(7)
    groups = defaultdict(list)
    for i, k, v in data:
        groups[k].append((-v, i))
    want = sorted((i,) for g in groups.values() for _, i in sorted(g)[:n])
    got = ranking.top_n_per_group(df, ["k"], [F.desc("v"), "id"], n)
    assert sorted((r.id,) for r in got.select("id").collect()) == want


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_sequential_id_whatever_the_partitioning(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(2000).select("id", (F.col("id") * 7919 % 3).alias("k"))
        got = ranking.with_sequential_id(df, ["k", F.desc("id")], "n").collect()
        want = sorted(((i * 7919 % 3, -i) for i in range(2000)))
        assert [(r.k, -r.id) for r in sorted(got, key=lambda r: r.n)] == want
        assert sorted(r.n for r in got) == list(range(1, 2001))
        top = ranking.top_n(df, ["k", F.desc("id")], 10)
        assert {r.id for r in top.collect()} == {-i for _, i in want[:10]}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_top_n_is_exact(spark):
    df = spark.range(30_000).select(((F.col("id") * 7919) % 30_000).alias("id"))
    got = sorted(r.id for r in ranking.top_n(df, ["id"], 12_345).collect())
    assert got == list(range(12_345))


# ---------------------------------------------------------------- joins


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_a_plain_join(spark, how):
    left = spark.range(6000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id % 40) END").alias("k"))
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("k2", 3), (None, 4)], "k string, v int")
    assert rows(skew_join(left, right, ["k"], ["id"], how)) == rows(left.join(right, "k", how))


def test_hot_and_missing_keys_are_split(spark):
    """A third of the rows share a key, a third have none: no task may get a third of them."""
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        left = spark.range(0, n, 1, 8).select(
            "id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        right = spark.range(0, n, 1, 8).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), F.col("id").alias("v"))
        joined = skew_join(left, right, ["k"], ["id"]).withColumn("task", F.spark_partition_id())
        sizes = [r["n"] for r in joined.groupBy("task").agg(F.count("id").alias("n"), F.max("pad"), F.max("v")).collect()]
        assert sum(sizes) == n
        assert max(sizes) < n / 8
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------------- redirects


def follow(url, edges, most):
    hops = 0
    while True:
        if url not in edges:
            return url, "ok", 200
        to, code = edges[url]
        if to is None:
            return (url, "ok", code) if code < 400 else (None, "http_error", code)
        hops, url = hops + 1, to
        if hops > most:
            return None, "too_many_redirects", None


@pytest.mark.parametrize("most", [1, 2, 5, 30])
def test_redirects_against_following_them(spark, most):
    rng = random.Random(most)
    edges = {}
    for i in range(300):
        kind = rng.random()
        if kind < 0.3:
            edges[f"u{i}"] = (None, rng.choice([200, 404, 500]))
        elif kind < 0.5:
            edges[f"u{i}"] = ("u0", 301)  # a popular target
        elif kind < 0.55:
            edges[f"u{i}"] = (f"gone{i}", 301)
        else:
            edges[f"u{i}"] = (f"u{rng.randrange(300)}", 302)
    edges["u0"] = ("hub1", 302)
    edges["hub1"] = ("hub2", 302)
    edges["hub2"] = (None, 200)
    edges["self"] = ("self", 302)
    for i in range(40):
        edges[f"c{i}"] = (f"c{i + 1}", 302)
    edges["c40"] = (None, 200)
    table = spark.createDataFrame([(a, b, c) for a, (b, c) in edges.items()], "from_url string, to_url string, http_code int")
    urls = spark.createDataFrame([(u,) for u in [*edges, "never-seen", None, "u1"]], "url string")
    got = redirects.resolve_redirects(urls, table, most)
    want = {u: follow(u, edges, most) for u in [*edges, "never-seen"]}
    assert {r.url: (r.url_original, r.status, r.http_code) for r in got.collect()} == want


def test_enrich_counts_the_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, url string")
    resolved = spark.createDataFrame([("a", "A", "ok", 200), ("b", None, "http_error", 404)], "url string, url_original string, status string, http_code int")
    plain = redirects.enrich_urls(df, resolved, ["id"])
    assert rows(plain, "id", "url_original") == [(1, "A"), (2, "A"), (3, None), (4, None)]
    counted = redirects.enrich_urls(df, resolved, ["id"], copies="copies")
    assert rows(counted, "id", "copies") == [(1, 2), (2, 2), (3, 1), (4, 1)]


# ---------------------------------------------------------------- backfill


def walk_windows(items, target, window=7, lookback=365):
    """items: (days_ago, id, url). Read windows by the clock, second by second steps."""
    end, start_limit, got, k = 0.0, -lookback * 86400.0, [], 0
    while len(got) < target and end > start_limit:
        start = end - window * 86400
        far, near = math.floor(-start / 86400) + (1 if start % 86400 else 0), math.floor(-end / 86400) + (1 if end % 86400 else 0)
        got += [(k, d, i, u) for d, i, u in sorted(items) if near <= d <= far]
        end, k = start - 1, k + 1
    seen, out = set(), []
    for _, _, i, u in got:
        if u and u not in seen:
            seen.add(u)
            out.append(i)
    return out[:target]


@pytest.mark.parametrize("target", [1, 3, 10, 40, 10_000])
def test_backfill_against_walking(spark, target):
    rng = random.Random(target)
    as_of = dt.date(2025, 2, 5)
    data, by_ticker = [], defaultdict(list)
    for i in range(600):
        ticker = "HOT" if i % 3 else f"T{i % 5}"
        ago = rng.choice([0, 7, 8, 14, 15, 16, 22, 363, 364, 365, 366, 370, rng.randrange(380)])
        url = rng.choice([None, "", f"u{rng.randrange(200)}", f"u{rng.randrange(200)}"])
        data.append((i, ticker, as_of - dt.timedelta(days=ago), url))
        by_ticker[ticker].append((ago, i, url))
    news = spark.createDataFrame(data, "id int, ticker string, day date, url string")
    got = bf.backfill(news, as_of, [F.desc("day"), "id"], default_target=target)
    have = defaultdict(set)
    for r in got.collect():
        have[r.ticker].add(r.id)
    want = {t: set(walk_windows(items, target)) for t, items in by_ticker.items()}
    assert {t: ids for t, ids in have.items()} == {t: ids for t, ids in want.items() if ids}


def test_a_day_in_two_windows(spark):
    df = spark.createDataFrame([(d,) for d in (0, 7, 8, 14, 15, 16, 22, 364, 365, 366, 372, 373)], "d int")
    last = bf.last_window(7, 365)
    got = {r.d: list(r.k) for r in df.select("d", bf.windows_of(F.col("d"), 7, last).alias("k")).collect()}
    assert last == 52
    assert got == {0: [0], 7: [0], 8: [1], 14: [1], 15: [1, 2], 16: [2], 22: [2, 3], 364: [51], 365: [51, 52], 366: [52], 372: [52], 373: []}


def test_symbols(spark):
    df = spark.createDataFrame([("BRK.B",), ("123",), ("abc",), ("TOOLONG",), ("",), (None,), ("A1",), ("AAPL",)], "symbol string")
    assert rows(bf.valid_symbols(df)) == [("A1",), ("AAPL",), ("BRK.B",)]
    assert rows(bf.sample_symbols(df, 10)) == [("A1",), ("BRK.B",)]
    assert bf.sample_symbols(df, 1, seed=1).count() == 1


def test_index_prefers_earlier_parts(spark):
    first = spark.createDataFrame([(1, "u"), (2, "v")], "id int, url string")
    second = spark.createDataFrame([(3, "u", "x"), (4, "w", "y")], "id int, url string, more string")
    assert rows(bf.build_index([first, second], "url", ["id"]), "id", "url", "more") == [(1, "u", None), (2, "v", None), (4, "w", "y")]


# ---------------------------------------------------------------- search and shape


def test_keywords_are_whole_words(spark):
    df = spark.createDataFrame([(1, "An IPO filing"), (2, "ipod sales"), (3, "the Chief  Executive"), (4, None), (5, "stock plunges")], "id int, t string")
    assert rows(search.keyword_search(df, ["t"]), "id") == [(1,), (3,), (5,)]


def test_domains(spark):
    urls = ["https://www.reuters.com/a", "https://reuters.com.evil.test", "https://finance.yahoo.com/x", "https://sports.yahoo.com", None, "https://notft.com"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id int, url string")
    assert rows(search.domain_filter(df, "url"), "id") == [(0,), (2,)]


def test_conform_defaults(spark):
    df = spark.createDataFrame(
        [(7, None, "https://WWW.a.test/x", None, "2024-01-01T00:00:05Z", "two words")],
        "doc int, final_url string, url_original string, full_text string, publishedAt string, content_truncated string",
    )
    row = cf.conform_article(df, ["doc"]).first()
    assert row.url == row.target_url == row.final_url == "https://WWW.a.test/x"
    assert (row.domain, row.word_count, row.http_code, row.http_status) == ("a.test", 2, 0, 0)
    assert (row.id, row.category, row.datetime, row.status, row.image) == (1, "finance", 1704067205, "", "")
    numeric = df.withColumn("error", F.lit(500.0)).withColumn("status", F.lit(403))
    assert cf.conform_article(numeric, ["doc"]).first().http_code == 500


def test_reports(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "ticker string")
    assert [tuple(r) for r in reports.value_counts(df, "ticker").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in reports.top_tickers(df).collect()] == [("b", 1), ("a", 2)]
    assert [tuple(r) for r in reports.share(df, "ticker").collect()] == [("a", 2, 66.7), ("b", 1, 33.3)]


# ---------------------------------------------------------------- pages


@pytest.mark.parametrize("inline", [0, 100])
def test_registered_domain(spark, inline):
    rules = spark.createDataFrame([(s,) for s in ("com", "uk", "co.uk", "*.ck", "!www.ck", "github.io")], "suffix string")
    cases = {
        "https://forums.bbc.co.uk/x": "bbc.co.uk", "https://www.a.com:80": "a.com", "http://user@b.c.d.com/": "d.com",
        "https://localhost:8080": "localhost", "https://www.ck": "www.ck", "https://a.b.ck/": "a.b.ck", "https://x.www.ck": "www.ck",
        "https://me.github.io": "me.github.io", "https://co.uk": ".co.uk", "https://x.unknown": "unknown", None: "", "": "",
    }
    df = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "id int, url string")
    got = pg.with_registered_domain(df, "url", rules, ["id"], inline_rules=inline)
    assert {r.url: r.domain for r in got.collect()} == cases


def test_pick_url_column(spark):
    df = spark.createDataFrame([("x", "https://a.test", "u")], "a string, b string, link string")
    assert pg.pick_url_column(df) == "link"
    assert pg.pick_url_column(df.drop("link")) == "b"
    with pytest.raises(ValueError):
        pg.pick_url_column(df.select("a"))


def test_scrape_outcomes(spark):
    text = "word " * 60
    pages = spark.createDataFrame(
        [("https://a.test/1", 200, f"<article>{text}</article>"), ("https://a.test/2", 404, "<p>gone</p>"), ("https://a.test/3", 0, None)],
        "url string, status int, html string",
    )
    links = ["https://a.test/1", "https://a.test/1 ", "https://a.test/2", "https://a.test/3", "https://a.test/4", "ftp://x", None, "https://login.yahoo.com/"]
    df = spark.createDataFrame(list(enumerate(links)), "id int, url_original string")
    got = {r.id: (r.extractor_used, r.status, r.error, r.text_length) for r in pg.scrape(df, pages, ["id"]).collect()}
    n = len(text.strip())
    assert got == {
        0: ("main", 200, None, n), 1: ("main", 200, None, n), 2: ("retry", 404, "http_status_404", 0),
        3: (None, 0, "fetch_error:NoResponse:no response captured", 0),
        4: (None, 0, "fetch_error:NotCaptured:no page captured", 0),
        5: (None, None, "invalid_url", 0), 6: (None, None, "invalid_url", 0), 7: (None, None, "blacklisted_domain", 0),
    }


def test_clean_lines_of_a_long_text(spark):
    lines = [f"Line {i % 1500}" if i % 2 else f"LINE {i % 1500}" for i in range(20_000)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, None), (3, ""), (4, " \n ")], "id int, t string")
    seen, kept = set(), []
    for line in lines:
        if line.lower() not in seen:
            seen.add(line.lower())
            kept.append(line)
    assert {r.id: r.t for r in clean_lines(df, "id", "t").collect()} == {1: "\n".join(kept), 2: None, 3: None, 4: ""}


# ---------------------------------------------------------------- tokens and vectors


def lookup_tables(spark):
    lexicon = spark.createDataFrame([("shares", "share"), ("ceos", "ceo")], "form string, lemma string")
    return lexicon, spark.createDataFrame([("the",), ("in",), ("and",)], "word string")


@pytest.mark.parametrize("inline", [0, 200])
def test_clean_tokens(spark, inline):
    lexicon, stop = lookup_tables(spark)
    given = ["the shares, __MONEY__ and ceos in uk! at&t s&p 5g __PERCENT__x ab abc é1 the", "", None]
    df = spark.createDataFrame(list(enumerate(given)), "id int, t string")
    got = {r.id: r.text_nc for r in tokens.clean_tokens(df, "id", "t", lexicon, stop, inline_rows=inline).collect()}
    assert got[0] == "share __MONEY__ ceo uk abc"
    assert got[1] == "" and not got[2]


def test_bag_of_words(spark):
    lexicon, stop = lookup_tables(spark)
    df = spark.createDataFrame([(1, "The Shares' share; a b2b"), (2, None)], "id int, t string")
    bag = tokens.bag_of_words(df, "id", "t", lexicon, stop)
    assert rows(bag) == [(1, "a", 1), (1, "bb", 1), (1, "share", 2)]


def toy_tfidf(texts, min_df=1, max_df=1.0, cap=None):
    docs = [Counter(t) for t in texts]
    n = len(docs)
    df = Counter(w for d in docs for w in d)
    cf = Counter(w for d in docs for w in d.elements())
    vocab = sorted((w for w in df if min_df <= df[w] <= max_df * n), key=lambda w: (-cf[w], w))[:cap]
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in vocab}
    out = {}
    for i, d in enumerate(docs):
        cells = {w: c * idf[w] for w, c in d.items() if w in idf}
        length = math.sqrt(sum(v * v for v in cells.values()))
        out.update({(i, w): v / length for w, v in cells.items()})
    return idf, out


@pytest.mark.parametrize("min_df,max_df,cap", [(1, 1.0, None), (2, 0.8, None), (1, 1.0, 7)])
def test_tfidf_against_the_formula(spark, min_df, max_df, cap):
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(12):02d}" for _ in range(rng.randrange(1, 30))] + ["all"] for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id int, t string")
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=min_df, max_df=max_df, max_features=cap)
    model = tfidf.fit_tfidf(df, "id", "t", config)
    idf, cells = toy_tfidf(texts, min_df, max_df, cap)
    vocabulary = model.vocabulary.orderBy("term_id").collect()
    assert [r.term for r in vocabulary] == sorted(idf) and [r.term_id for r in vocabulary] == list(range(len(idf)))
    assert all(abs(r.idf - idf[r.term]) < 1e-12 for r in vocabulary)
    if "all" in idf:
        assert abs(idf["all"] - 1.0) < 1e-12
    got = {(r.id, r.term): r.weight for r in tfidf.transform_tfidf(model, df).collect()}
    assert got.keys() == cells.keys()
    assert all(abs(got[k] - cells[k]) < 1e-12 for k in cells)


def test_tfidf_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(i, f"alpha beta{i % 2} gamma") for i in range(6)], "id int, t string")
    model = tfidf.fit_tfidf(df, "id", "t", tfidf.TfidfConfig(min_df=1, max_df=1.0, max_features=None))
    tfidf.save_model(model, str(tmp_path / "m"))
    again = tfidf.load_model(spark, str(tmp_path / "m"))
    assert (again.config, again.n_docs, again.row_id, again.col) == (model.config, 6, "id", "t")
    assert rows(tfidf.transform_tfidf(again, df), "id", "term") == rows(tfidf.transform_tfidf(model, df), "id", "term")


def test_cosine_of_given_pairs(spark):
    texts = ["aa bb cc", "aa bb dd", "ee ff", "aa bb cc"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    model = tfidf.fit_tfidf(df, "id", "t", tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0))
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (0, 0), (1, 0)], "a int, b int")
    got = {(r.a, r.b): r.cosine for r in tfidf.cosine_pairs(tfidf.transform_tfidf(model, df), pairs, "id").collect()}
    _, cells = toy_tfidf([t.split() for t in texts])
    dot = lambda a, b: sum(v * cells.get((b, w), 0) for (i, w), v in cells.items() if i == a)
    assert all(abs(got[p] - dot(*p)) < 1e-12 for p in got) and len(got) == 5
    assert got[(0, 2)] == 0.0


# ---------------------------------------------------------------- topics


def planted_bag(spark):
    rng = random.Random(3)
    data = []
    for doc in range(60):
        words = Counter(f"{'left' if doc % 2 else 'right'}{rng.randrange(8)}" for _ in range(30))
        data += [(doc, w, c) for w, c in words.items()]
    return spark.createDataFrame(data, "id int, term string, cnt int"), data


def test_planted_topics_are_separated(spark):
    bag, _ = planted_bag(spark)
    model = topics.fit_nmf(bag, "id", k=2, max_rounds=30, tol=0.0)
    assert all(b <= a + 1e-9 * a for a, b in zip(model.losses, model.losses[1:]))
    assert not model.topics.where("h0 < 0 OR h1 < 0").count() and not model.docs.where("w0 < 0 OR w1 < 0").count()
    assigned = {r.id: r.topic for r in topics.assign_topic(topics.transform_nmf(model, bag), "id").collect()}
    assert len(assigned) == 60
    assert len({assigned[d] for d in range(1, 60, 2)}) == 1 and len({assigned[d] for d in range(0, 60, 2)}) == 1
    assert assigned[0] != assigned[1]
    names = {r.topic: r.name for r in topics.name_topics(model).collect()}
    assert all(part.startswith("left") for part in names[assigned[1]].split("_"))
    assert len(names[0].split("_")) == 4


def test_factors_settle_by_the_tolerance(spark):
    bag, _ = planted_bag(spark)
    model = topics.fit_nmf(bag, "id", k=2, max_rounds=200, tol=1e-3)
    errors = [max(loss, 0) ** 0.5 for loss in model.losses]
    assert 2 <= len(errors) < 200
    assert errors[-2] - errors[-1] < 1e-3 * errors[0]
    assert all(a - b >= 1e-3 * errors[0] for a, b in zip(errors[:-2], errors[1:-1]))
    # Weights of a document do not depend on the rows that are solved beside it.
    one = {(r.id, r.topic): r.loading for r in topics.transform_nmf(model, bag).collect()}
    few = {(r.id, r.topic): r.loading for r in topics.transform_nmf(model, bag.where("id < 5").coalesce(1)).collect()}
    assert all(one[k] == v for k, v in few.items())


def test_nmf_losses_are_those_of_the_factors(spark):
    bag, data = planted_bag(spark)
    model = topics.fit_nmf(bag, "id", k=3, max_rounds=4)
    terms = {r.term: [r.h0, r.h1, r.h2] for r in model.topics.collect()}
    docs = {r.id: [r.w0, r.w1, r.w2] for r in model.docs.collect()}
    names = sorted(terms)
    x = np.zeros((60, len(names)))
    for d, t, c in data:
        x[d, names.index(t)] = c
    w, h = np.array([docs[d] for d in range(60)]), np.array([terms[t] for t in names]).T
    assert abs(((x - w @ h) ** 2).sum() - model.losses[-1]) < 1e-6 * model.losses[-1]


def test_labels_of_texts_without_terms(spark):
    bag, _ = planted_bag(spark)
    model = topics.fit_nmf(bag, "id", k=2, max_rounds=10)
    df = spark.createDataFrame([(0, "x"), (1, "y"), (900, "12"), (901, None)], "id int, t string")
    got = {r.id: r.topic for r in topics.label_topics(df, "t", model, topics.transform_nmf(model, bag)).collect()}
    names = {r.topic: r.name for r in topics.name_topics(model).collect()}
    assert got[900] == names[0] and got[901] is None and got[0] != got[1]


def test_ties_go_to_the_lowest_topic(spark):
    weights = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5), (2, 0, 0.1), (2, 1, 0.2)], "id int, topic int, loading double")
    assert rows(topics.assign_topic(weights, "id")) == [(1, 0), (2, 1)]


def test_repeated_edges_count_once(spark):
    edges = [("a", "b", 302), ("b", "c", 302), ("c", None, 200)] * 2 + [("a", "old", 302), (None, "x", 302)]
    df = spark.createDataFrame([(*e, 1 if e[1] == "old" else 2) for e in edges], "from_url string, to_url string, http_code int, n int")
    urls = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "url string")
    got = redirects.resolve_redirects(urls, df, captured=[F.desc("n")]).collect()
    assert sorted((r.url, r.url_original, r.status) for r in got) == [("a", "c", "ok"), ("z", "z", "ok")]


def test_repeated_captures_count_once(spark):
    page = "<html><body><article><p>" + "words of the article " * 20 + "</p></article></body></html>"
    pages = spark.createDataFrame(
        [("http://h.test/a", 200, page, 1), ("http://h.test/a", 404, None, 2), ("http://h.test/a", 200, page, 1), ("http://h.test/b", 200, page, 1), (None, 200, page, 1)],
        "url string, status int, html string, n int",
    )
    df = spark.createDataFrame([(1, "http://h.test/a "), (2, "http://h.test/a"), (3, "ftp://x"), (4, None)], "id int, url_original string")
    first = {r.id: r for r in pages_of(df, pages, [F.asc("n")])}
    last = {r.id: r for r in pages_of(df, pages, [F.desc("n")])}
    assert len(first) == len(last) == 4
    assert [first[i].status for i in (1, 2, 3)] == [200, 200, None] and [last[i].status for i in (1, 2)] == [404, 404]


def pages_of(df, captures, captured):
    return pg.scrape(df, captures, ["id"], captured=captured).collect()


def test_released_tables_leave_no_rows(spark):
    from newsloom.session import bucketed, released, stored

    for table in (stored(spark.range(100), "t"), bucketed(spark.range(100), "id", "t", 4)):
        path = table.scratch_path
        assert spark.read.parquet(path).count() == 100
        released(table)
        assert spark.read.parquet(path).count() == 0
        assert not table.scratch_name or not spark.catalog.tableExists(table.scratch_name)
