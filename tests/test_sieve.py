"""The sketch of terms: nothing frequent is held back, most of the rest is, and far fewer rows are shuffled."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import tfidf


@pytest.mark.parametrize("bits, least", [(4, 3), (10, 3), (16, 2), (12, 200)])
def test_no_term_of_enough_documents_is_held_back(spark, bits, least):
    rng = np.random.default_rng(bits)
    docs = [np.unique(np.concatenate([rng.zipf(1.3, 60), rng.integers(1 << 40, 1 << 62, 20)])).astype(np.int64).tolist() for _ in range(400)]
    docs += [[], [-5, -1]] * least
    df = Counter(h for d in docs for h in d)
    sieve = tfidf.Sieve(least, bits).fill(spark.createDataFrame([(d,) for d in docs], "hashes array<long>").repartition(7))
    frequent = np.array([h for h, n in df.items() if n >= least])
    assert len(frequent) and sieve.lets_through(frequent).all()
    rare = np.array([h for h, n in df.items() if n < least])
    if bits == 16:
        assert sieve.lets_through(rare).mean() < 0.1
    told = spark.createDataFrame([([int(frequent[0]), int(rare[0])],), ([],), (None,)], "h array<long>").select(sieve.mask(spark, F.col("h")).alias("m")).collect()
    assert told[0]["m"] == sieve.lets_through(np.array([frequent[0], rare[0]])).tolist() and told[1]["m"] == []


def test_rare_terms_do_not_fill_it(spark):
    """Many more rare terms than there are places: the sieve of a large corpus."""
    rng = np.random.default_rng(1)
    rare = rng.integers(1, 1 << 62, 60_000)
    docs = [[*part.tolist(), *range(-40, 0)] for part in np.array_split(rare, 30)]
    sieve = tfidf.Sieve(3, 12).fill(spark.createDataFrame([(d,) for d in docs], "hashes array<long>").repartition(5))
    assert sieve.lets_through(np.arange(-40, 0)).all() and sieve.lets_through(rare).mean() < 0.05


@pytest.mark.parametrize("config", [tfidf.TfidfConfig(), tfidf.TfidfConfig(ngram_range=(1, 3), min_df=2), tfidf.TfidfConfig(min_df=0.1), tfidf.TfidfConfig(min_df=1)])
def test_the_same_model_with_and_without(spark, monkeypatch, config):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) if rng.random() < 0.7 else f"x{rng.random()}" for _ in range(30))) for i in range(120)] + [(998, None), (999, " ")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    with_it = tfidf.fit_tfidf(df, "id", "text", config)
    cells = {(r["id"], r["term"]): r["weight"] for r in tfidf.transform_tfidf(with_it, df).collect()}
    monkeypatch.setattr(tfidf, "sieve_of", lambda *a: None)
    without = tfidf.fit_tfidf(df, "id", "text", config)
    assert (with_it.sieve is None) == (config.min_df == 1)
    assert sorted(map(tuple, with_it.vocabulary.collect())) == sorted(map(tuple, without.vocabulary.collect()))
    plain = {(r["id"], r["term"]): r["weight"] for r in tfidf.transform_tfidf(without, df).collect()}
    assert cells.keys() == plain.keys() and max(abs(cells[k] - plain[k]) for k in cells) < 1e-12


def test_rows_shuffled_are_at_least_halved(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    config = tfidf.TfidfConfig()
    sieve = tfidf.sieve_of(texts, "text", config, 3)
    whole, rest = (tfidf.document_terms(texts, "doc_id", "text", config, s).count() for s in (None, sieve))
    terms = tfidf.document_terms(texts, "doc_id", "text", config, sieve).select("term").distinct().count()
    kept = tfidf.fit_tfidf(texts, "doc_id", "text", config).vocabulary.count()
    assert rest < whole / 2 and terms < 1.3 * kept
