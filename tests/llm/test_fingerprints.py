"""Fingerprints: edited texts, equality, order, increments and likeness."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import fingerprints
from newsloom.llm.registry import QUERIES
from tests.llm.data import awkward, read, rows_of, text, write

OP = QUERIES["op7_fingerprints"]


def edited_texts(docs):
    texts = [d["text"] or "" for d in sorted(docs, key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, d["text"] or ""))]
    for i, t in enumerate(texts):
        h = len(t) // 2
        yield t, t[: len(t) - h] + texts[(i + 1) % len(texts)][:h]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_awkward_rows(spark, tmp_path, partitions):
    sf = write(tmp_path, True, documents=awkward(random.Random(5), 90))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows_of(OP(spark, sf))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    docs = read(sf, "documents")
    key = lambda t, e: (len(t), hashlib.sha256(e.encode()).hexdigest())
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted(key(t, e) for t, e in edited_texts(docs))
    prints = {}
    text_of = {d["doc_id"]: d["text"] or "" for d in docs}
    for r in got:
        prints.setdefault(text_of[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) <= (r["near_edited"] == 1)
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) == len(prints)
    long = [r for r in got if r["n_chars"] > 300]
    assert sum(r["near_edited"] for r in long) / len(long) > sum(r["near_next"] for r in long) / len(long) + 0.2


def test_few_rows(spark, tmp_path):
    assert rows_of(OP(spark, write(tmp_path, documents=[]))) == []
    (one,) = rows_of(OP(spark, write(tmp_path, documents=[(7, "alone here", None, None, None)])))
    assert one["edited_sha256"] == hashlib.sha256(b"alonealone").hexdigest() and one["near_next"] == 1
    got = rows_of(OP(spark, write(tmp_path, documents=[(None, None, None, None, None), (None, "b", None, None, None), (2, "cd", None, None, None)])))
    assert sorted(r["edited_sha256"] for r in got) == sorted(hashlib.sha256(e).hexdigest() for e in (b"", b"b", b"c"))


def test_order_and_increments(spark):
    rng = random.Random(6)
    a, b = [text(rng, 20) for _ in range(6)], [text(rng, 20) for _ in range(3)]
    rows = [(0, "\n".join(a)), (1, "\n".join(reversed(a))), (2, "\n".join(a + b)), (3, "\n".join(b))]
    prints = fingerprints.fingerprints(spark.createDataFrame(rows, "id int, text string"), ["id"])
    whole = prints.select("id", F.struct("exact", "lanes", "n_windows").alias("p"))
    p = {r["id"]: r["p"] for r in whole.collect()}
    assert p[0] == p[1] and p[0] != p[2]
    both = whole.where("id = 0").select(F.col("p").alias("x")).crossJoin(whole.where("id = 3").select(F.col("p").alias("y")))
    (sums,) = both.select(fingerprints.plus(F.col("x"), F.col("y")).alias("s"), fingerprints.minus(fingerprints.plus(F.col("x"), F.col("y")), F.col("y")).alias("d")).collect()
    assert sums["s"] == p[2] and sums["d"] == p[0]


def test_neighbours_need_one_shuffle(spark, tmp_path):
    docs = spark.read.parquet(f"{write(tmp_path, documents=awkward(random.Random(7), 20))}/documents.parquet")
    plan = fingerprints.with_next(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan


def near(spark, pairs):
    """Likeness of the two texts of every pair."""
    rows = [(i, k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)]
    prints = fingerprints.fingerprints(spark.createDataFrame(rows, "id int, k int, text string"), ["id", "k"])
    made = prints.withColumn("vector", fingerprints.signed(F.col("lanes"), F.col("n_windows"))).orderBy("id", "k").collect()
    dot = lambda a, b: sum(x * y for x, y in zip(a["vector"], b["vector"]))
    return [max(0, dot(a, b)) / (dot(a, a) * dot(b, b)) ** 0.5 for a, b in zip(made[::2], made[1::2])]


def test_half_kept_texts_of_few_sentences_are_told_from_others(spark):
    rng = random.Random(8)
    long = lambda: text(rng, 200)
    signs = lambda: "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(300))
    half = lambda a, b: a[: len(a) - len(a) // 2] + b[: len(a) // 2]
    said = lambda: "one phrase " * 90
    pairs = [(a, half(a, make())) for make in (long, signs) for a in [make() for _ in range(4)]] + [(a, half(a, said())) for a in (long(), long())]
    assert min(near(spark, pairs)) > 0.3
    assert max(near(spark, [(make(), make()) for make in (long, signs) for _ in range(4)])) < 0.3


def test_counters_have_sums_of_their_own(spark):
    made = fingerprints.fingerprints(spark.createDataFrame([(0, "a b c")], "id int, text string"), ["id"])
    (one,) = made.select(F.struct("exact", "lanes", "n_windows").alias("p")).collect()
    many = spark.range(1).select(F.lit(0).alias("id")).join(made, "id")
    for _ in range(24):
        p = F.struct("exact", "lanes", "n_windows")
        many = spark.createDataFrame(many.select("id", fingerprints.plus(p, p).alias("p")).select("id", "p.*").collect(), made.schema)
    (big,) = many.collect()
    assert big["n_windows"] == 1 << 24 and big["lanes"] == [x << 24 for x in one["p"]["lanes"]] and len(big["lanes"]) == 120 and set(one["p"]["lanes"]) <= {0, 1}


def brute_lanes(spark, t):
    """The number of different windows and, of each hash bit, how many have it, by plain loops over Spark's own hash."""
    counts, total = [0] * len(fingerprints.LANES), 0
    for paragraph in t.split("\n"):
        words = [p for w in re.split(r"[ \t\n\x0b\f\r]+", paragraph) for p in (w[i : i + fingerprints.PIECE] for i in range(0, len(w), fingerprints.PIECE))]
        starts = range(max(1, len(words) - fingerprints.WINDOW + 1))
        windows = {tuple(words[i : i + fingerprints.WINDOW]) + (None,) * (fingerprints.WINDOW - len(words)) for i in starts}
        rows = spark.createDataFrame([w for w in windows], "a string, b string, c string")
        hashed = rows.select(F.xxhash64(*[F.when(F.col(x).isNotNull(), F.xxhash64(x)) for x in "abc"]).alias("h"))
        for r in hashed.select(*[F.xxhash64(F.lit(s), "h") for s in fingerprints.LANE_SEEDS]).collect():
            total += 1
            bits = [(h >> fingerprints.FIELD * f + j) & 1 for h in r for f in range(3) for j in range(fingerprints.FIELD_BITS)]
            counts = [c + b for c, b in zip(counts, bits)]
    return counts, total


def test_counters_equal_brute_force_across_slices(spark, monkeypatch):
    rng = random.Random(9)
    texts = ["", "one", "two words", "a b c d e f g", "\n\n x", "\n".join(text(rng, rng.randint(0, 25)) for _ in range(20)), text(rng, 90) + " " + "long" * 30, "same same same same same"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = {r["id"]: (r["lanes"], r["n_windows"], r["exact"]) for r in fingerprints.fingerprints(frame, ["id"]).collect()}
    for i, t in enumerate(texts):
        assert whole[i][:2] == brute_lanes(spark, t)
    monkeypatch.setattr(fingerprints, "PARAGRAPHS_IN_SLICE", 3)
    monkeypatch.setattr(fingerprints, "WINDOWS_IN_SLICE", 5)
    assert {r["id"]: (r["lanes"], r["n_windows"], r["exact"]) for r in fingerprints.fingerprints(frame, ["id"]).collect()} == whole


def test_fields_cannot_overflow():
    assert fingerprints.PARAGRAPHS_IN_SLICE * fingerprints.WINDOWS_IN_SLICE < 1 << fingerprints.FIELD
    assert fingerprints.FIELD * fingerprints.FIELDS <= 63 and fingerprints.FIELD_BITS < fingerprints.FIELD
