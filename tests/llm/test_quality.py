"""Quality classifier: statistics against brute force, held-out accuracy, awkward rows."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa

from newsloom.llm import quality
from newsloom.llm.registry import QUERIES
from tests.llm.data import SF, awkward, read, rows_of, text, write

OP = QUERIES["op5_quality_classifier"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def test_statistics_equal_brute_force():
    rng = random.Random(15)
    texts = [d[1] for d in awkward(rng, 30)]
    got = quality.statistics(pa.array(texts, pa.string()))
    name = quality.STATISTICS.index
    for t, x in zip(texts, got):
        data = (t or "").encode()
        if not data:
            assert not x.any()
            continue
        words = re.findall(rb"[^\x20\x09-\x0D]+", data)
        n = max(1, len(words))
        lines = [w for w in data.split(b"\n") if w]
        assert abs(x[name("upper")] - sum(65 <= b < 91 for b in data) / len(data)) < 1e-12
        assert abs(x[name("high")] - sum(b > 127 for b in data) / len(data)) < 1e-12
        assert abs(x[name("word_length")] - sum(map(len, words)) / n) < 1e-9
        assert abs(x[name("distinct_words")] - len(set(words)) / np.sqrt(n)) < 1e-9
        assert abs(x[name("distinct_lines")] - len(set(lines)) / max(1, len(lines))) < 1e-9
        assert abs(x[name("same_as_before")] - sum(a == b for a, b in zip(words, words[1:])) / n) < 1e-9


def test_isotonic_is_the_closest_rising_line():
    good, weight = np.array([1.0, 0, 3, 1, 4]), np.array([2.0, 2, 4, 4, 4])
    assert quality.isotonic(np.arange(5), good, weight).tolist() == [0.25, 0.25, 0.5, 0.5, 1.0]


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in read("/root/testdata/sf0.01", "labels")}
    got = rows_of(OP(spark, "/root/testdata/sf0.01"))
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    out = [(r["score"], r["predicted"] == labels[r["doc_id"]], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(ok for _, ok, _ in out) >= 0.95 * len(out)
    assert min(s for s, _, y in out if y) > np.median([s for s, _, y in out if not y])


def test_awkward_rows_and_labels(spark, tmp_path):
    rng = random.Random(16)
    docs = awkward(rng, 150) + [(1000 + i, text(rng, 40).upper().replace(" ", "!! "), "en", None, None) for i in range(60)] + [(None, "x", None, None, None)]
    labels = [(d[0], int(d[0] is None or d[0] < 1000), None) for d in docs] + [(3, None, 0), (None, None, None), (99999, 1, 1)]
    sf = write(tmp_path, True, documents=docs, labels=labels)
    got = rows_of(OP(spark, sf))
    assert len(got) == len(docs)
    shout = [r["predicted"] for r in got if r["doc_id"] is not None and 1000 <= r["doc_id"] < 1060 and r["held_out"]]
    plain = [r["predicted"] for r in got if r["doc_id"] is not None and r["doc_id"] < 150 and r["held_out"]]
    assert sum(shout) <= 0.2 * len(shout) and sum(plain) >= 0.9 * len(plain)


def test_little_to_learn_from(spark, tmp_path):
    docs = [(1, "a", None, None, None), (2, None, None, None, None)]
    assert rows_of(OP(spark, write(tmp_path, documents=[], labels=[]))) == []
    assert {r["score"] for r in rows_of(OP(spark, write(tmp_path, documents=docs, labels=[])))} == {0.5}
    assert {r["score"] for r in rows_of(OP(spark, write(tmp_path, documents=docs, labels=[(1, 1, 0), (2, 1, 0)])))} == {1.0}


def test_extra_columns_stay(spark, tmp_path):
    sf = write(tmp_path, True, documents=awkward(random.Random(17), 30), labels=[(i, i % 2, 0) for i in range(30)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    told = quality.scored(docs, quality.learn(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    assert set(told.columns) == {*docs.columns, "predicted"} and told.count() == docs.count()
    assert SF
