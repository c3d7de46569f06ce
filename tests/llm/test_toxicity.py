"""Toxicity: word expressions and values against a plain model, both ways of scoring, held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from newsloom.llm import toxicity
from newsloom.llm.language import byte_chunks
from newsloom.llm.registry import QUERIES
from tests.llm.data import awkward, read, rows_of, text, write

OP = QUERIES["op12_toxicity"]
BAD = ["vileness", "dreckig", "abjectement", "grim"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


def words(t):
    out, now = [], ""
    for c in (t or "") + " ":
        if c.isalpha():
            now += c.lower()[0]
        elif now:
            out.append(now)
            now = ""
    return out


def links(word):
    return [word[:k] for k in toxicity.LINKS if len(word) > k] + [word + "$"]


def plain_values(docs):
    """The value of every word, by the rules as the docstring says them."""
    counts, parent = [Counter(), Counter()], {}
    for t, toxic in docs:
        for w in set(words(t)):
            chain = links(w)
            counts[toxic].update(chain)
            parent.update(zip(chain, [None, *chain]))
    kind = lambda g: len(toxicity.LINKS) if g.endswith("$") else toxicity.LINKS.index(len(g))
    follow = Counter(parent.values())
    own = [Counter({g: max(n - 1, 0) for g, n in c.items()}) for c in counts]
    sums = [[sum(n for g, n in c.items() if kind(g) == k) for k in range(4)] for c in own]
    seen = [sum(n for c in counts for g, n in c.items() if kind(g) == k) for k in range(4)]
    left = [1 - (sums[0][k] + sums[1][k]) / max(1, seen[k]) for k in range(4)]

    def chance(c, g):
        if g is None:
            return 1.0
        k = kind(g)
        return (1 - left[k]) * own[c][g] / max(1, sums[c][k]) + left[k] * chance(c, parent[g]) / (follow[parent[g]] + 1)

    def value(g):
        before = value(parent[g]) if parent[g] else 0.0
        now = math.log(1 - toxicity.MIXED + toxicity.MIXED * chance(1, g) / chance(0, g))
        return now if abs(now - before) > toxicity.TOLERANCE else before

    return lambda w: next((value(g) for g in reversed(links(w)) if g in parent), 0.0)


def sample(rng, n=160):
    docs = []
    for i in range(n):
        t = text(rng, rng.randint(5, 40), rng.choice(["en", "de", "fr"])).split(" ")
        bad = i % 5 == 0
        for _ in range(3 * bad):
            t.insert(rng.randrange(len(t) + 1), rng.choice(BAD) + rng.choice(["", "s", "en", "Ü", "!"]))
        docs.append((" ".join(t).capitalize() if i % 2 else " ".join(t).upper(), int(bad)))
    return docs


def test_words_are_split_like_letters_say():
    texts = ["Êtion ärger, x2y I'm", "", None, "日本 ｆｕｌｌ ﬁ Ⅷ", "a\nb\tabcdefgh", "😀 𝔸bc é"]
    for _, rows, data, offsets in byte_chunks(pa.array(texts, pa.string())):
        row, keys = toxicity.word_links(data, offsets)
        assert Counter(row.tolist()) == Counter({i: len(words(t)) for i, t in enumerate(texts[:5]) if words(t)}) | Counter({5: 3})
        assert rows == len(texts) and (keys[:, -1] != 0).all()
    same = [toxicity.word_links(*next(byte_chunks(pa.array([t])))[2:])[1] for t in ("ÊTREs", "êtres", "êtreS zu")]
    assert (same[0][0] == same[1][0]).all() and (same[0][0] == same[2][0]).all() and [k != 0 for k in same[0][0]] == [True, False, False, True]


def test_values_equal_the_plain_model(spark):
    docs = sample(random.Random(41))
    frame = spark.createDataFrame(docs, "text string, toxic int").repartition(4)
    kept = toxicity._values(toxicity.count_nodes(frame).persist())
    lookup = toxicity.Model(kept, None).lookup
    value = plain_values(docs)
    texts = [t for t, _ in docs] + ["neverseen vilenessly GRIMM", "", None, "x", text(random.Random(42), 50_000)]
    got = lookup.texts(pa.array(texts, pa.string()))
    for t, x in zip(texts, got):
        own = words(t)
        assert abs(x - sum(map(value, own)) / (len(own) + toxicity.SHRINK)) < 1e-5


def test_both_ways_of_scoring_agree(spark):
    rng = random.Random(43)
    docs = [(i, t, y) for i, (t, y) in enumerate(sample(rng, 200))]
    docs += [(900, None, None), (901, "", None), (902, "?!", None), (903, docs[0][1], None), (None, docs[0][1], None), (904, text(rng, 20_000), None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic")
    told = []
    for bound in (1 << 20, 0):
        model = toxicity.learn(frame.select("doc_id", "text"), labels, bound)
        assert (model.lookup is None) == (bound == 0)
        told.append({(r["doc_id"], r["toxic"]): (r["score"], r["predicted"]) for r in toxicity.scored(frame, model).collect()})
    assert told[0].keys() == told[1].keys() and len(told[0]) == len(docs)
    assert max(abs(told[0][k][0] - told[1][k][0]) for k in told[0]) < 1e-5
    assert told[0][(0, 1)] == told[0][(903, None)] == told[0][(None, None)]


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in read("/root/testdata/sf0.01", "labels")}
    got = rows_of(OP(spark, "/root/testdata/sf0.01"))
    assert all(r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    out = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in out) >= 0.95 * len(out) and sum(p for p, y in out if y) >= 0.8 * sum(y for _, y in out)


def test_awkward_rows_and_labels(spark, tmp_path):
    rng = random.Random(44)
    docs = awkward(rng, 150) + [(1000 + i, t, "en", None, None) for i, (t, _) in enumerate(sample(rng, 300))] + [(None, "x", None, None, None)]
    labels = [(d[0], 1, int(d[0] is not None and d[0] >= 1000 and d[0] % 5 == 0)) for d in docs] + [(3, None, None), (None, None, None), (99999, 1, 1)]
    got = rows_of(OP(spark, write(tmp_path, True, documents=docs, labels=labels)))
    assert len(got) == len(docs)
    out = [r for r in got if r["held_out"] and r["doc_id"] is not None]
    bad = [r["predicted"] for r in out if r["doc_id"] >= 1000 and r["doc_id"] % 5 == 0]
    clean = [r["predicted"] for r in out if not (r["doc_id"] >= 1000 and r["doc_id"] % 5 == 0)]
    assert sum(bad) >= 0.9 * len(bad) and sum(clean) <= 0.03 * len(clean)


def test_little_to_learn_from(spark, tmp_path):
    docs = [(1, "a", None, None, None), (2, None, None, None, None)]
    assert rows_of(OP(spark, write(tmp_path, documents=[], labels=[]))) == []
    assert {r["score"] for r in rows_of(OP(spark, write(tmp_path, documents=docs, labels=[])))} == {0.5}
    assert {r["score"] for r in rows_of(OP(spark, write(tmp_path, documents=docs, labels=[(2, 1, 0), (1, 1, 0)])))} == {0.0}
    assert {r["score"] for r in rows_of(OP(spark, write(tmp_path, documents=[*docs, (5, "b", None, None, None)], labels=[(2, 1, 0), (1, 1, 1), (5, 1, 0)])))} <= {0.0, 0.5, 1.0, 1 / 3, 2 / 3}


def test_pools_rise():
    seen, toxic = np.zeros(toxicity.STEPS), np.zeros(toxicity.STEPS)
    for at, s, t in ((200, 4, 1), (210, 4, 0), (300, 2, 1), (400, 3, 3)):
        seen[at], toxic[at] = s, t
    made = toxicity.pooled(seen, toxic)
    assert made.chances.tolist() == [0.125, 0.5, 1.0]
    assert (np.diff(made(np.linspace(-1, 5, 200))) >= 0).all()
