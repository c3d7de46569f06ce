"""The shingle join against brute force: awkward rows, near copies, large families, every helper."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import jaccard_join, shingles
from newsloom.llm.components import components
from newsloom.llm.registry import QUERIES
from tests.llm.data import awkward, read, rows_of, text, write

OP = QUERIES["op6_jaccard_join"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute(docs):
    """(doc_id, n, component) per row."""
    sets = [brute_set(d["text"]) for d in docs]
    groups = Groups()
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and 100 * o >= 85 * len(a | sets[j]):
                groups.join(i, j)
    least = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            least[groups.find(i)] = min(least.get(groups.find(i), d["doc_id"]), d["doc_id"])
    return sorted(((d["doc_id"], len(s), least.get(groups.find(i))) for i, (d, s) in enumerate(zip(docs, sets))), key=str)


def near_copies(rng, start, copies, words=60):
    base = text(rng, words).split()
    for k in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"edit{rng.randint(0, 40)}"
        yield (start + k, " ".join(own) if k % 4 else " ".join(own).upper() + "\n", None, None, None)


def test_awkward_rows_and_near_copies(spark, tmp_path):
    rng = random.Random(20)
    rows = awkward(rng, 40) + [d for g in range(4) for d in near_copies(rng, 1000 + 100 * g, 60)]
    rows += [(None, rows[0][1], None, None, None), (None, "only null ids here", None, None, None), (5000, "a b c", None, None, None), (5001, "A b\tC", None, None, None), (5002, "a b", None, None, None)]
    passage = text(rng, 60)
    rows += [(6000 + i, f"{text(rng, 40)} {passage} {text(rng, 40)}", None, None, None) for i in range(50)]
    sf = write(tmp_path, True, documents=rows)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(OP(spark, sf))), key=str)
    assert got == brute(read(sf, "documents"))


def test_families_in_several_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_SETS", 16)
    rng = random.Random(21)
    sf = write(tmp_path, documents=list(near_copies(rng, 0, 120)) + list(near_copies(rng, 500, 30)))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(OP(spark, sf))), key=str)
    assert got == brute(read(sf, "documents"))


def test_no_rows_and_no_words(spark, tmp_path):
    assert rows_of(OP(spark, write(tmp_path, documents=[]))) == []
    got = rows_of(OP(spark, write(tmp_path, documents=[(2, None, None, None, None), (1, " ", None, None, None)])))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("longest", [1, 2, 3, 40])
def test_candidates_lose_no_link(spark, longest):
    """Whatever lists count as long, linked sets are a pair or in one family."""
    rng = random.Random(22)
    texts = [t for _, t, *_ in near_copies(rng, 0, 40)] + [text(rng, 30) for _ in range(20)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    none = jaccard_join.Frequent(np.zeros(0, np.uint32), np.zeros(0, np.int64))
    found = jaccard_join.candidates(jaccard_join.postings(docs, none), longest).collect()
    groups, pairs = Groups(), set()
    for r in found:
        groups.join(r["a"], r["b"])
        pairs.add((r["a"], r["b"]))
    sets = {shingles.digest(s): (s, brute_set(t)) for t, (_, s) in zip(texts, shingles.shingle_sets(pa.array(texts), 4))}
    for a in sets:
        for b in sets:
            x, y = sets[a][1], sets[b][1]
            if a < b and 100 * len(x & y) >= 85 * len(x | y):
                assert (a, b) in pairs or groups.find(a) == groups.find(b)


def test_the_order_puts_frequent_shingles_last():
    own = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50, np.uint64))
    frequent = jaccard_join.Frequent(np.sort(jaccard_join.keys_of(own[[3, 30]])), np.array([100, 5000]))
    levels = frequent.levels(own)
    assert np.flatnonzero(levels).tolist() == [3, 30] and levels[3] < levels[30]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, (1 << 28) - 1), max_size=60) | st.sets(st.integers(0, 2000), max_size=300))
def test_packed_keys_come_back(keys):
    own = np.array(sorted(keys), np.uint32)
    assert jaccard_join.unpack_keys(jaccard_join.pack_keys(own, 0), 0).tolist() == own.tolist()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 300), st.integers(0, 2000), st.integers(0, 99))
def test_bitmaps_never_exceed_the_difference(common, one, two, seed):
    pool = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, common + one + two + 2, np.uint64))
    a, b = pool[: common + one + 1], np.concatenate([pool[:common], pool[common + one + 1 :]])
    assert jaccard_join.difference(jaccard_join.bitmap(a), jaccard_join.bitmap(b)) <= len(np.setxor1d(a, b))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=2, max_size=14), st.booleans(), st.randoms())
def test_family_links_join_all_that_is_linked(sets, two_sides, rng):
    sides = np.array([rng.randint(0, 1) if two_sides else 0 for _ in sets])
    across = len(set(sides.tolist())) > 1
    want, got = Groups(), Groups()
    linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    for i in range(len(sets)):
        for j in range(i):
            if linked(i, j) and (not across or sides[i] != sides[j]):
                want.join(i, j)
    for i, j in jaccard_join.compare_family([np.array(sorted(s), np.uint64) for s in sets], sides):
        assert linked(i, j)
        got.join(i, j)
    assert [want.find(i) for i in range(len(sets))] == [got.find(i) for i in range(len(sets))]


def test_components_of_random_graphs(spark):
    rng = random.Random(23)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(70)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(1, 60)]
    groups = Groups()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {x: groups.find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_equal_brute_force():
    rng = random.Random(24)
    texts = [d[1] for d in awkward(rng, 40)] + ["\t lead and trail \n", "x", "é É", "a" * 3000]
    for t, (_, own) in zip(texts, shingles.shingle_sets(pa.array(texts, pa.string()), 4)):
        assert len(own) == len(brute_set(t))
