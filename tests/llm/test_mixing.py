"""Mixing against a plain statement of the targets, on awkward rows."""

import random
import re
from collections import defaultdict

import pytest

from newsloom.llm import mixing
from newsloom.llm.registry import QUERIES
from tests.llm.data import CLASHES, awkward, read, rows_of, write

OP = QUERIES["op9_mix_sources"]


def wanted(docs):
    """Targets by resharing the excess until nobody is above twice its size."""
    size = defaultdict(int)
    for d in docs:
        size[d["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * size[s]]
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= set(over)
    return size, target


def check(docs, got):
    size, target = wanted(docs)
    assert len(got) == len(docs)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["size"] <= r["source_size"] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in size:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 or len(docs) != len({d["doc_id"] for d in docs})


@pytest.mark.parametrize("clash", [False, True])
def test_targets_are_met(spark, tmp_path, clash):
    sf = write(tmp_path, clash, documents=awkward(random.Random(1), 150))
    docs, got = read(sf, "documents"), rows_of(OP(spark, sf))
    check(docs, got)
    assert sorted(map(str, got)) == sorted(map(str, rows_of(OP(spark, sf))))


def test_no_rows_and_no_words(spark, tmp_path):
    assert rows_of(OP(spark, write(tmp_path, documents=[]))) == []
    got = rows_of(OP(spark, write(tmp_path, documents=[(1, None, None, "a", None), (2, " ", None, None, 1)])))
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_operator_keeps_the_rows(spark, tmp_path):
    sf = write(tmp_path, True, documents=awkward(random.Random(2), 30))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = mixing.mix(docs)
    assert set(mixed.columns) == set(docs.columns)
    assert mixed.drop("copies").exceptAll(docs.drop("copies")).count() == 0
    assert {r["copies"] for r in mixed.select("copies").collect()} <= {0, 1, 2}
    assert all(r["hash"] == "hash!" for r in mixed.select("hash").collect())
    assert "hash" in CLASHES


def test_the_boundary_is_found_at_every_level(spark, tmp_path):
    """Four bits a level: the budget ends in a bucket that has to be cut again and again."""
    docs = [(i, "w " * (1 + i % 7), "en", "abc"[i % 3], None) for i in range(600)]
    sf = write(tmp_path, documents=docs)
    from pyspark.sql import functions as F

    sizes = spark.read.parquet(f"{sf}/documents.parquet").select(
        mixing.key_of(F.col("source")).alias("source_key"), "source", mixing.n_words(F.col("text")).alias("size"), mixing.row_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )
    plan = mixing.thresholds(sizes, mixing.source_targets(sizes), levels=12, bits=4)
    taken = mixing.copies_of(sizes, plan).groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("g"))
    assert all(abs(r["t"] - r["g"]) <= 3.5 for r in taken.collect())
