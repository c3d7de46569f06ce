"""Fitted topics: the start against numpy's SVD, least squares, both ways of holding terms, and the end."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import nmf, topics

N_DOCS, N_TERMS = 60, 40


@pytest.fixture(scope="module")
def counts():
    rng = np.random.default_rng(3)
    topics = rng.gamma(0.4, 1.0, (4, N_TERMS))
    x = rng.poisson(rng.gamma(0.5, 2.0, (N_DOCS, 4)) @ topics)
    x[0, :] = 0
    x[1, 0] = 5000  # a hot document
    x[:, 1] += 3  # a term of all documents
    x[0, 1] = 0
    return x


@pytest.fixture(scope="module")
def bow(spark, counts):
    rows = [(int(d), f"t{t:02d}", int(counts[d, t])) for d, t in zip(*np.nonzero(counts))]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, term string, cnt long").repartition(5).persist()


def used(counts):
    return counts[counts.any(1)][:, counts.any(0)].astype(float)


def test_least_squares_meets_its_conditions():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(5, 30)), rng.normal(size=(200, 30))
    a[4] = 0
    gram, right = a @ a.T, b @ a.T
    for start in (None, rng.random((200, 5))):
        y = nmf.least_squares(gram, right, start)
        slope = y @ gram - right
        assert (y >= 0).all() and np.abs(slope[:, :4][y[:, :4] > 1e-12]).max() < 1e-6 and slope[y == 0].min() > -1e-6


@pytest.mark.parametrize("held", [1 << 20, 0])
def test_leading_vectors_and_start_equal_numpy(spark, counts, bow, held):
    x = used(counts)
    packed, terms = nmf.pack_documents(bow, "doc_id")
    first = np.random.default_rng(6).normal(size=(x.shape[1], 20))
    holder = nmf.Held(packed, first) if held else nmf.Kept(packed, nmf.Held(packed, first).table(), 20)
    vectors, sigma = nmf.leading_vectors(holder, 4)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(sigma, s[:4], rtol=1e-6)
    start = nmf.nndsvd_topics(vectors, sigma).table().orderBy("term_id").collect()
    got = np.array([r["v"] for r in start])
    for j in range(4):
        up, vp, un, vn = np.maximum(u[:, j], 0), np.maximum(vt[j], 0), -np.minimum(u[:, j], 0), -np.minimum(vt[j], 0)
        norm = np.linalg.norm
        mine, pair = max(((norm(up) * norm(vp), (up, vp)), (norm(un) * norm(vn), (un, vn))), key=lambda m: m[0])
        want = np.sqrt(s[j]) * np.abs(vt[j]) if j == 0 else np.sqrt(s[j] * mine) * pair[1] / norm(pair[1])
        assert np.abs(got[:, j] - want).max() < 1e-4 * want.max()


@pytest.mark.parametrize("held", [1 << 20, 0])
def test_fit_settles_below_multiplicative_updates(spark, counts, bow, held):
    x = used(counts)
    fit = nmf.factor_nmf(bow, "doc_id", 3, max_rounds=30 if held else 4, held_terms=held)
    assert all(b <= a * (1 + 1e-10) for a, b in zip(fit.losses, fit.losses[1:]))
    h = np.array([[r[f"h{j}"] for j in range(3)] for r in fit.topics.orderBy("term").collect()]).T
    w = np.array([[r[f"w{j}"] for j in range(3)] for r in fit.docs.orderBy("doc_id").collect()])
    assert w.shape == (len(x), 3) and abs(((x - w @ h) ** 2).sum() - fit.losses[-1]) < 1e-6 * (x**2).sum()
    rng = np.random.default_rng(7)
    mw, mh = rng.random((len(x), 3)), rng.random((3, x.shape[1]))
    for _ in range(len(fit.losses)):
        mw *= (x @ mh.T) / (mw @ mh @ mh.T + 1e-12)
        mh *= (mw.T @ x) / (mw.T @ mw @ mh + 1e-12)
    assert fit.losses[-1] <= ((x - mw @ mh) ** 2).sum() * (1 + 1e-9)
    told = nmf.optimality(bow, fit).first()
    assert abs(told["loss"] - fit.losses[-1]) < 1e-6 * told["squares"] and told["steepest_weights"] < 1e-8 and told["least"] >= 0


def test_both_ways_agree(spark, bow):
    # The start differs (numbers of one generator or of hashes), the rounds do not: from one start they give one end.
    packed, _ = nmf.pack_documents(bow, "doc_id")
    n = packed.select(F.max(F.array_max("term_ids"))).first()[0] + 1
    values = np.random.default_rng(8).random((n, 3))
    held = nmf.Held(packed, values)
    kept = nmf.Kept(packed, held.table(), 3)
    solve, measure = (lambda x: nmf.least_squares(values.T @ values, x)), (lambda x, w: np.append((w.T @ w).ravel(), (x * w).sum()))
    (a, am), (b, bm) = held.product(solve, measure), kept.product(solve, measure)
    rows = {r["term_id"]: r["v"] for r in b.table().collect()}
    assert np.allclose(am, bm) and np.allclose(a.values, [rows[i] for i in range(n)])
    assert np.allclose(held.map(lambda v, o: v + o, a).values, [r["v"] for r in kept.map(lambda v, o: v + o, b).table().orderBy("term_id").collect()])


def test_more_topics_than_documents(spark):
    bow = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "b", 3)], "doc_id long, term string, cnt long")
    fit = nmf.factor_nmf(bow, "doc_id", 4)
    assert fit.losses[-1] < 1e-12 and fit.topics.columns == ["term", "h0", "h1", "h2", "h3"] and fit.docs.count() == 2
    with pytest.raises(ValueError):
        nmf.factor_nmf(bow.where("cnt > 9"), "doc_id", 2)


@pytest.mark.parametrize("most", [1, 50, 1 << 21])
def test_blocks_hold_every_cell_once_and_look_a_term_up_once(spark, counts, bow, monkeypatch, most):
    monkeypatch.setattr(nmf, "CELLS_A_BLOCK", most)
    packed, _ = nmf.pack_documents(bow, "doc_id")
    blocks = nmf.blocked(packed)
    told = [(d, t, c) for r in blocks.collect() for d, t, c in zip(np.repeat(r["ids"], r["lengths"]), np.array(r["terms"])[r["codes"]], r["counts"])]
    want = [(r["doc_id"], t, c) for r in packed.collect() for t, c in zip(r["term_ids"], r["counts"])]
    assert sorted(told) == sorted(want)
    assert all(len(set(r["terms"])) == len(r["terms"]) for r in blocks.collect())
    assert nmf.blocked(packed) is blocks


def test_topics_of_many_terms_look_a_term_up_once_a_block(spark, bow, monkeypatch):
    """`fit_nmf` and `transform_nmf` with the terms in tables against the same with the terms held, and what meets the terms."""
    texts = bow.unionAll(spark.createDataFrame([(900, "only here", 3)], bow.schema))
    held = topics.fit_nmf(texts, "doc_id", 3, 4, tol=-1.0)
    new = texts.where("doc_id <> 3").unionAll(spark.createDataFrame([(901, "known to none", 3)], bow.schema))
    key = lambda rows: sorted(map(tuple, rows), key=str)
    want = key(topics.transform_nmf(held, new, 5, tol=-1.0).collect())
    monkeypatch.setattr(topics, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(topics, "is_small", lambda table: False)
    monkeypatch.setattr(nmf, "CELLS_A_BLOCK", 200)
    kept = topics.fit_nmf(texts, "doc_id", 3, 4, tol=-1.0)
    assert np.allclose(kept.losses, held.losses)
    for a, b in ((kept.topics, held.topics), (kept.docs, held.docs)):
        a, b = key(a.collect()), key(b.collect())
        assert a and a[0] and [r[0] for r in a] == [r[0] for r in b] and np.allclose([r[1:] for r in a], [r[1:] for r in b])
    got = key(topics.transform_nmf(kept, new, 5, tol=-1.0).collect())
    assert len(got) == 3 * 59 and [r[:2] for r in got] == [r[:2] for r in want] and np.allclose([r[2] for r in got], [r[2] for r in want])
    blocks = nmf.blocked(texts.documents["doc_id"]).count()
    assert 4 < blocks < 30 and nmf.wanted_terms(texts.documents["doc_id"]).count() <= blocks * (N_TERMS + 1) < texts.count()


def test_cells_of_one_document_meet_wherever_they_lie(spark, monkeypatch):
    """Runs of an id in many batches, ids that repeat and none at all: one document in one block, of all its cells."""
    monkeypatch.setattr(nmf, "CELLS_AT_A_TIME", 7)
    monkeypatch.setattr(nmf, "CELLS_A_BLOCK", 40)
    rng = np.random.default_rng(4)
    rows = [(None if i % 11 == 0 else int(i), f"t{t}", int(c)) for i, t, c in zip(rng.integers(0, 30, 400), rng.integers(0, 25, 400), rng.integers(1, 9, 400))]
    bow = spark.createDataFrame([*rows, (3, None, 5)], "doc int, term string, cnt long").repartition(6)
    blocks = nmf.blocked(nmf.documents_of(bow, "doc", nmf.numbered_terms(bow))).collect()
    told = [(d, r["terms"][t], c) for r in blocks for d, t, c in zip([i for i, n in zip(r["ids"], r["lengths"]) for _ in range(n)], r["codes"], r["counts"])]
    assert sorted(told, key=str) == sorted(((d, t, float(c)) for d, t, c in rows), key=str)
    ids = [i for r in blocks for i in r["ids"]]
    assert len(blocks) > 4 and len(ids) == len(set(ids)) == len({r[0] for r in rows})
    assert all(len(set(r["terms"])) == len(r["terms"]) for r in blocks)


def test_a_round_moves_only_what_blocks_look_up_and_add_up(spark, bow):
    """Values of terms lie in the buckets of those that look them up: tables of terms meet without a shuffle, and documents stay where they are."""
    packed, _ = nmf.pack_documents(bow, "doc_id")
    kept = nmf.Kept(packed, nmf.Held(packed, np.ones((packed.select(F.max(F.array_max("term_ids"))).first()[0] + 1, 2))).table(), 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = kept.product(lambda x: x, lambda x, w: np.zeros(1))[0]
        values = sums.map(lambda v, s: v + s, sums)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan(values._beside((sums,))) and "Exchange" not in plan(values._beside((sums,)))
        text = plan(values.by_block(lambda block: None, nmf.SUMS))
        assert text.count("Exchange hash") == 1 and "Exchange hashpartitioning(of_block" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_block_and_a_part_of_the_terms_meet_in_one_row(spark, bow, monkeypatch):
    """Rows that move in a pass are as many as blocks times parts of terms, not terms, and two fits share the blocks."""
    monkeypatch.setattr(nmf, "CELLS_A_BLOCK", 200)
    monkeypatch.setattr(nmf, "PARTS_A_BUCKET", 1)
    texts, parts = bow.select("*"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    fits = [nmf.factor_nmf(texts, "doc_id", k, max_rounds=2, held_terms=0) for k in (1, 2)]
    packed = texts.documents["doc_id"]
    blocks, wanted = nmf.blocked(packed).collect(), nmf.wanted_terms(packed).collect()
    assert len(blocks) > 4 and len(wanted) <= len(blocks) * parts < sum(len(r["terms"]) for r in blocks)
    assert sum(len(r["ids"]) // 8 for r in wanted) == sum(len(r["terms"]) for r in blocks)
    values = nmf.Kept(packed, packed.named.select("term_id", F.array(F.lit(1.0)).alias("v")), 1)
    assert values.rows.count() <= parts and values.product(lambda x: x, lambda x, w: np.zeros(1))[0].rows.count() <= parts
    assert fits[1].losses[-1] < fits[0].losses[-1]


def test_optimality_is_that_of_the_cells_whose_term_and_document_have_weights(spark, counts, bow):
    fit = nmf.factor_nmf(bow, "doc_id", 3, max_rounds=2)
    model = nmf.FittedNmf(fit.topics.where("term <> 't05'"), fit.docs.where("doc_id % 5 <> 0"), 3, "doc_id", ())
    told = nmf.optimality(bow, model).first()
    h, w = ({r[0]: np.array(r[1:]) for r in table.collect()} for table in (model.topics, model.docs))
    docs, terms = sorted(w), sorted(h)
    x = counts[np.ix_(docs, [int(t[1:]) for t in terms])].astype(float)
    wm, hm = np.array([w[d] for d in docs]), np.array([h[t] for t in terms])

    def steepest(own, other, x):
        slope = own @ (other.T @ other) - x @ other
        return np.abs(np.where(own > 0, slope, np.minimum(slope, 0)))[x.any(1)].max() / (x @ other).max()

    want = ((x**2).sum(), ((x - wm @ hm.T) ** 2).sum(), steepest(hm, wm, x.T), steepest(wm, hm, x))
    assert np.allclose([told[n] for n in ("squares", "loss", "steepest_topics", "steepest_weights")], want)
    assert told["least"] == min(wm[x.any(1)].min(), hm[x.any(0)].min())
