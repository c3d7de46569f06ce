"""N-grams counted as numbers, and weights by chunks, against the same inside the row and by a sent vocabulary."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.functions.text import counted, ngrams, words
from newsloom.operators import tfidf, tokens


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)] + ["ÉTÉ", "ΣΑΣ", "straße", "x_1", "中文", "a", "-"]
    rows = [(rng.randrange(60), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 40)))) for _ in range(150)]
    rows += [(None, "w1 w2 w1 w2"), (None, "w1 w3"), (7, "w5"), (8, None), (9, " \n "), (10, "- a"), (11, "w1 " * 5000)]
    return spark.createDataFrame(rows, "id int, text string").repartition(5)


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 3)])
def test_counts_equal_those_inside_the_row(texts, low, high, monkeypatch):
    monkeypatch.setattr(tfidf, "WORDS_AT_A_TIME", 50)
    config = tfidf.TfidfConfig(ngram_range=(low, high))
    native = texts.where("text is not null").select("id", F.inline(counted(ngrams(words(F.col("text")), low, high))))
    want = sorted(map(tuple, native.collect()), key=str)
    terms = tfidf.document_terms(texts, "id", "text", config)
    assert sorted(map(tuple, terms.collect()), key=str) == want and terms.dtypes == native.dtypes
    stats = {(r["term"], r["df"], r["cf"]) for r in tfidf.corpus_stats(texts, "text", config).collect()}
    assert stats == {(r["term"], r["df"], r["cf"]) for r in tfidf.term_stats(native).collect()}


@pytest.mark.parametrize("norm", ["l2", "l1", None])
def test_weights_by_chunks_equal_those_of_a_sent_vocabulary(texts, norm, monkeypatch):
    model = tfidf.fit_tfidf(texts, "id", "text", tfidf.TfidfConfig(norm=norm, sublinear_tf=norm == "l1"))
    sent = tfidf.transform_tfidf(model, texts)
    key = lambda r: (str(r["id"]), r["term_id"], r["weight"])
    want = sorted(sent.collect(), key=key)
    monkeypatch.setattr(tfidf, "is_small", lambda table: False)
    monkeypatch.setattr(tfidf, "WORDS_AT_A_TIME", 60)
    monkeypatch.setattr(tfidf, "WORDS_A_CHUNK", 200)
    chunked = tfidf.transform_tfidf(model, texts)
    got = sorted(chunked.collect(), key=key)
    assert chunked.dtypes == sent.dtypes and len(got) == len(want) > 1000
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert max(abs(a["weight"] - b["weight"]) for a, b in zip(got, want)) < 1e-12


def test_a_chunk_looks_a_term_up_once(spark, monkeypatch):
    """Cells by the hundred for a term, but a row for each chunk and term where the vocabulary is met."""
    df = spark.createDataFrame([(i, "all of these words are in each of the texts") for i in range(400)], "id int, text string")
    model = tfidf.fit_tfidf(df, "id", "text", tfidf.TfidfConfig(max_df=1.0))
    monkeypatch.setattr(tfidf, "is_small", lambda table: False)
    weights = tfidf.transform_tfidf(model, df)
    joins = [line for line in weights._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and weights.count() == 400 * model.vocabulary.count()
    packed = [c for c in tfidf_tables(weights)]
    assert packed and sum(len(r["terms"]) for r in packed[0].select("terms").collect()) <= 8 * model.vocabulary.count()


def tfidf_tables(weights):
    spark = weights.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in weights.inputFiles()}:
        table = spark.read.parquet(path)
        if "terms" in table.columns:
            yield table


def test_texts_are_read_to_be_measured_and_numbered_alone(spark, texts, monkeypatch):
    """Fit and weights by chunks take the texts' words from numbers that were stored once."""
    read, rows = spark.sparkContext.accumulator(0), texts.count()

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = texts.mapInArrow(told, "id int, text string")
    model = tfidf.fit_tfidf(df, "id", "text")
    monkeypatch.setattr(tfidf, "is_small", lambda table: False)
    got = tfidf.transform_tfidf(model, df)
    assert got.count() > 1000 and read.value == 2 * rows
    # The chunks that meet their terms hold numbers of words, not cells; and each id is in one of them.
    numbered = tfidf.numbered_texts(df, "id", "text")
    assert sorted(numbered.select(F.explode("ids").alias("id")).distinct().collect(), key=str) == sorted(
        numbered.select(F.explode(F.array_distinct("ids")).alias("id")).collect(), key=str
    )
    assert numbered.agg(F.sum(F.size("codes"))).first()[0] == df.select(F.size(words(F.col("text"))).alias("n")).where("n > 0").agg(F.sum("n")).first()[0]


def test_more_text_makes_more_parts_of_numbers(spark, texts, monkeypatch):
    monkeypatch.setattr(tfidf, "TEXT_A_PART", 500)
    monkeypatch.setattr(tfidf, "WORDS_A_CHUNK", 100)
    df = texts.select("*")
    size = sum(len((r["text"] or "").encode()) for r in df.collect() if (r["text"] or "").strip())
    chunks = [r["chunk"] for r in tfidf.numbered_texts(df, "id", "text").select("chunk").collect()]
    assert len({c >> tfidf.CHUNK_BITS for c in chunks}) > 16 and max(c >> tfidf.CHUNK_BITS for c in chunks) < -(-size // 500)
    assert len(set(chunks)) == len(chunks)


@pytest.mark.parametrize("high", [2, 3])
def test_runs_too_many_to_tell_beside_a_document_are_numbered(monkeypatch, high):
    """The same counts whether or not a key of run and document fits in one number."""
    rng = np.random.default_rng(3)
    lengths, names = np.array([5, 0, 9, 1, 30]), pa.array([f"w{i}" for i in range(6)])
    word = np.concatenate([np.arange(6), rng.integers(0, 6, lengths.sum() - 6)])

    def counts():
        cells = tfidf._cells(names, word, lengths, tfidf.TfidfConfig(ngram_range=(1, high)))
        return sorted(zip(cells.doc.tolist(), cells.terms.take(pa.array(cells.term)).to_pylist(), cells.count.tolist()))

    plain = counts()
    monkeypatch.setattr(tfidf, "MOST_KEYS", 1)
    want = {}
    for doc, (start, n) in enumerate(zip(np.cumsum(lengths) - lengths, lengths)):
        own = [f"w{i}" for i in word[start : start + n]]
        for k in range(1, high + 1):
            for i in range(n - k + 1):
                want[doc, " ".join(own[i : i + k])] = want.get((doc, " ".join(own[i : i + k])), 0) + 1
    assert counts() == plain == sorted((*k, n) for k, n in want.items())


def test_a_large_table_of_few_files_is_dealt_out(spark, tmp_path, monkeypatch):
    from newsloom import session

    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(20_000).repartition(9).write.parquet(str(tmp_path / "nine"))
    monkeypatch.setattr(session, "SMALL_SHARE", 2000)
    one, nine = (spark.read.parquet(str(tmp_path / name)) for name in ("one", "nine"))
    assert session.spread(one, "id").rdd.getNumPartitions() > 8
    # So is one whose splits are large, but not one of small splits.
    assert session.spread(nine, "id").rdd.getNumPartitions() > nine.rdd.getNumPartitions()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        fine = spark.read.parquet(str(tmp_path / "nine"))
        assert "Exchange" not in session.spread(fine, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("sent", [True, False])
def test_bags_by_join_are_dealt_by_the_size_of_the_texts(spark, texts, monkeypatch, sent):
    """More text makes more parts, not larger ones, and the counts stay those of each id."""
    lexicon = spark.createDataFrame([("all", "every"), ("all", "zz"), (None, "x"), ("wa", None)], "form string, lemma string")
    stops = spark.createDataFrame([("straße",), ("stop",), (None,)], "word string")
    rows = texts.withColumn("text", F.translate("text", "0123456789", "abcdefghij")).withColumn("text", F.concat("text", F.lit(" all stop")))
    want = {}
    for r in tokens.bag_of_words(rows, "id", "text", lexicon, stops).collect():
        want[r["id"], r["term"]] = want.get((r["id"], r["term"]), 0) + r["cnt"]
    monkeypatch.setattr(tokens, "PART_BYTES", 500)
    if not sent:
        monkeypatch.setattr(tokens, "is_small", lambda table: False)
    bag = tokens.bag_of_words(rows, "id", "text", lexicon, stops, inline_rows=0)
    size = sum(len((r["text"] or "").encode()) for r in rows.collect())
    assert re.search(rf"hashpartitioning\(id#\d+L?, {-(-size // 500)}\)", bag._jdf.queryExecution().executedPlan().toString())
    got = bag.collect()
    assert len(got) == len(want) > 300 and {(r["id"], r["term"]): r["cnt"] for r in got} == want


def test_counting_takes_few_bytes_a_word():
    """Places and counts are 32-bit numbers, and what is sorted is sorted where it lies."""
    import tracemalloc

    n = 1 << 18
    names, word = pa.array([f"w{i}" for i in range(1000)]), np.random.default_rng(1).integers(0, 1000, n)
    tracemalloc.start()
    try:
        cells = tfidf._cells(names, word, np.full(n // 256, 256), tfidf.TfidfConfig())
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert cells.count.sum() == 2 * n - n // 256 and most < 150 * n


def test_a_chunk_and_a_part_of_the_vocabulary_meet_in_one_row(spark, texts, monkeypatch):
    """Terms travel packed, a row for a chunk and a part; cells leave a chunk in slices; and the weights stay what they were."""
    model = tfidf.fit_tfidf(texts.select("*"), "id", "text")
    want = sorted(tfidf.transform_tfidf(model, texts.select("*")).collect(), key=lambda r: (str(r["id"]), r["term_id"], r["weight"]))
    for name, value in {"is_small": lambda table: False, "WORDS_A_CHUNK": 300, "CELLS_OUT": 7, "LEAST_PARTS": 3}.items():
        monkeypatch.setattr(tfidf, name, value)
    df = texts.select("*")
    numbered = tfidf.numbered_texts(df, "id", "text")
    found = tfidf._looked_up(model, numbered, model.vocabulary, tfidf._counted(numbered, None, model.config, model.sieve)).collect()
    parts = max(2 * spark.sparkContext.defaultParallelism, 3)
    n_terms = sum(len(r["at"]) // 8 for r in found)
    assert len({r["of_chunk"] for r in found}) == numbered.count() > 4 and len(found) <= numbered.count() * parts < n_terms
    got = sorted(tfidf.transform_tfidf(model, df).collect(), key=lambda r: (str(r["id"]), r["term_id"], r["weight"]))
    assert [r[:3] for r in got] == [r[:3] for r in want] and max(abs(a["weight"] - b["weight"]) for a, b in zip(got, want)) < 1e-12
