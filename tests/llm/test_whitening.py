"""Whitening: against a dense eigensolver, repeated singular values, rank, awkward vectors."""

import random

import numpy as np
import pytest

from newsloom.llm import whitening
from newsloom.llm.registry import QUERIES
from tests.llm.data import rows_of, write
from tests.llm.test_centroids import awkward_vectors, usable, vectors

OP = QUERIES["op13_whitening"]


def integers(rows):
    return np.array([np.floor(1024 * np.array(r[1], np.float32).astype(float)) for r in rows]).astype(np.int64) + 100_000


def dense(x):
    n, sums = len(x), x.sum(0)
    c = (n * x - sums) / n
    values, components = np.linalg.eigh(c.T @ c / n)
    deviation = [sum(int(v) ** 2 for v in row) for row in (n * x - sums).tolist()]
    return c, values[::-1], components[:, ::-1], deviation


def check(got, x, ids, count=8):
    c, values, components, deviation = dense(x)
    assert len(got) == count * len(x) and {r["component"] for r in got} == set(range(1, count + 1))
    assert {r["n"] for r in got} == {len(x)} and max(r["identity_error"] for r in got) < 1e-9
    share = {r["component"]: r["explained"] for r in got}
    assert np.allclose([share[i + 1] for i in range(count)], values[:count] / values.sum(), rtol=1e-9)
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == sorted(zip(ids, deviation))
    return c, values, components


def test_equals_a_dense_solver(spark, tmp_path):
    rows = vectors(random.Random(31), 300, 0.1)
    got = rows_of(OP(spark, write(tmp_path, embeddings=rows)))
    x = integers(rows)
    c, values, components = check(got, x, range(300))
    for i in range(8):
        mine = np.array([r["whitened"] for r in sorted((r for r in got if r["component"] == i + 1), key=lambda r: r["vec_id"])])
        theirs = c @ components[:, i] / np.sqrt(values[i])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-9


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_vectors(spark, tmp_path, clash):
    rows = [r for r in awkward_vectors(random.Random(32), 90) if r[0] is not None]
    got = rows_of(OP(spark, write(tmp_path, clash, embeddings=rows)))
    kept = [r for r in rows if usable(r[1])]
    check(got, integers(kept), [r[0] for r in kept])


def test_repeated_singular_values(spark, tmp_path):
    # Plus and minus each unit vector: all deviations are equal but for the floor.
    rows = [(2 * i + s, [(1 - 2 * s) * float(i == j) for j in range(64)], 0) for i in range(64) for s in (0, 1)]
    check(rows_of(OP(spark, write(tmp_path, embeddings=rows))), integers(rows), range(128))


def test_rank_bounds_the_components(spark, tmp_path):
    rng = np.random.default_rng(33)
    flat = np.rint(rng.normal(size=(200, 3)) @ rng.integers(-3, 4, (3, 64)) * 8) / 1024
    flat = np.rint(rng.integers(-9, 10, (200, 3))) @ rng.integers(-3, 4, (3, 64)) / 1024
    rows = [(i, v.tolist(), 0) for i, v in enumerate(flat)]
    check(rows_of(OP(spark, write(tmp_path, embeddings=rows))), integers(rows), range(200), 3)


def test_nothing_to_whiten(spark, tmp_path):
    assert rows_of(OP(spark, write(tmp_path, embeddings=[]))) == []
    one = vectors(random.Random(34), 1)
    assert rows_of(OP(spark, write(tmp_path, embeddings=one))) == []
    assert rows_of(OP(spark, write(tmp_path, embeddings=[(i, one[0][1], 0) for i in range(9)] + [(99, None, 0), (100, [None] * 64, 0)]))) == []


def test_bidiagonal_form(spark, tmp_path):
    rows = vectors(random.Random(35), 150, 0.2)
    frame = spark.read.parquet(f"{write(tmp_path, embeddings=rows)}/embeddings.parquet").repartition(5)
    own = whitening.centred(whitening.blocks_of(frame, "embedding").persist())
    x = own.rows(integers(rows))
    for steps in (10, None):
        right, b, last = whitening.bidiagonalise(own, steps)
        k = len(b)
        assert np.abs(right.T @ right - np.eye(k)).max() < 1e-12 and not np.tril(b, -1).any() and not np.triu(b, 2).any()
        left = x @ right @ np.linalg.inv(b)
        assert np.abs(left.T @ left - np.eye(k)).max() < 1e-9
        assert (k, last == 0) == ((10, False) if steps else (64, True))


def test_large_deviations_end_at_the_largest_long():
    made = whitening.Whitening(1 << 33, np.zeros(2, np.int64), np.eye(2), np.ones(2), 1.0, np.zeros(2))
    assert made.deviations(np.array([[1 << 20, 0], [0, 0]])).tolist() == [whitening.MOST, 0]
    made = whitening.Whitening(3, np.array([3, 3]), np.eye(2), np.ones(2), 1.0, np.zeros(2))
    assert made.deviations(np.array([[5, 1], [1, 1]])).tolist() == [144, 0]
