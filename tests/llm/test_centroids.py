"""Centroid clusters: against brute force, ties, awkward vectors, and the shape of what moves."""

import hashlib
import math
import random

import numpy as np
import pytest

from newsloom.llm import centroids
from newsloom.llm.registry import QUERIES
from tests.llm.data import rows_of, write

OP = QUERIES["op11_centroid_clusters"]


def usable(v):
    return v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, k=16, rounds=3):
    kept = [(r[0], [math.floor(64 * float(np.float32(x))) for x in r[1]]) for r in rows if usable(r[1])]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [x for _, x in order[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda x: min(range(len(centers)), key=lambda c: (away(x, centers[c]), c))
    for _ in range(rounds):
        own = [[] for _ in centers]
        for _, x in kept:
            own[place(x)].append(x)
        centers = [[sum(col) // len(xs) for col in zip(*xs)] if xs else c for c, xs in zip(centers, own)]
    told = [(i, place(x), away(x, centers[place(x)])) for i, x in kept]
    sums = [sum(d for _, p, d in told if p == c) for c in range(len(centers))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, p, d, sums[p], sum(sums), digest[p]) for i, p, d in told), key=repr)


def found(spark, sf):
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r[n] for n in names) for r in rows_of(OP(spark, sf))), key=repr)


def vectors(rng, n, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(64)], i % 3) for i in range(n)]


def awkward_vectors(rng, n):
    rows = vectors(rng, n)
    broken = [None, [], [1.0] * 63, [1.0] * 65, [None] + [0.5] * 63, [float("nan")] + [0.5] * 63, [float("inf")] * 64]
    rows += [(n + i, v, None) for i, v in enumerate(broken)]
    # Copies, shared ids, a null id, and a third of all rows equal.
    return rows + [(3, rows[3][1], 1), (4, rows[5][1], 1), (None, rows[6][1], 1), *[(10_000 + i, rows[0][1], 0) for i in range(n // 2)]]


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_vectors_as_brute_force(spark, tmp_path, clash):
    rows = awkward_vectors(random.Random(21), 120)
    assert found(spark, write(tmp_path, clash, embeddings=rows)) == brute(rows)


def test_ties_go_to_the_smaller_number(spark, tmp_path):
    # Few different integers: many vectors lie on planes between centroids.
    rng = random.Random(22)
    rows = [(i, [rng.choice([-1, 0, 1]) / 64 for _ in range(2)] + [0.0] * 62, 0) for i in range(200)]
    got = found(spark, write(tmp_path, embeddings=rows))
    assert got == brute(rows) and len({r[1] for r in got}) < 16


def test_few_or_no_vectors(spark, tmp_path):
    assert found(spark, write(tmp_path, embeddings=[])) == []
    assert found(spark, write(tmp_path, embeddings=[(1, None, 0)])) == []
    rows = vectors(random.Random(23), 5)
    got = found(spark, write(tmp_path, embeddings=rows))
    assert got == brute(rows) and {r[4] for r in got} == {0}


def test_huge_numbers_do_not_overflow(spark, tmp_path):
    rows = [(i, [(-1) ** (i // 20) * 3e38] * 64, 0) for i in range(40)]
    got = found(spark, write(tmp_path, embeddings=rows))
    assert len(got) == 40 and {r[2] for r in got} == {0}


def test_tournament_is_exact():
    rng = np.random.default_rng(24)
    for k in (1, 2, 3, 17):
        centers, x = rng.integers(-3, 4, (k, 5)), rng.integers(-3, 4, (500, 5))
        away = ((x[:, None] - centers[None]) ** 2).sum(2)
        planes = centroids.Bisectors(centers)
        best = planes.nearest(x)
        assert (best == away.argmin(1)).all() and (planes.distances(x, best) == away.min(1)).all()


def test_other_columns_stay(spark, tmp_path):
    sf = write(tmp_path, True, embeddings=awkward_vectors(random.Random(25), 30))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    out, centers = centroids.cluster(rows, k=4, rounds=1)
    assert set(out.columns) == set(rows.columns) - {"embedding"} and len(centers) == 4
    assert {r["integers"] for r in out.select("integers").collect()} == {"integers!"}


def test_a_round_moves_sums_only(spark, tmp_path):
    rows = spark.read.parquet(f"{write(tmp_path, embeddings=vectors(random.Random(26), 400))}/embeddings.parquet").repartition(8)
    ints = centroids.integer_vectors(rows, "embedding", "x")
    n, sums = centroids.cluster_sums(ints, "x", centroids.Bisectors(np.zeros((3, 64), np.int64)))
    assert n.tolist() == [400, 0, 0] and sums.shape == (3, 64) and not sums[1:].any()
