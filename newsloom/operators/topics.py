"""Topics by non-negative factorisation of a bag of words, in long form.

Multiplicative updates after Lee & Seung (2001), distributed as by Liu et al. (WWW 2010):
the k x k products are small, everything else is a join and a sum over non-zero cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import BROADCAST_ROWS, is_small
from newsloom.operators.ranking import top_n_per_group
from newsloom.session import released, stored

EPS = 1e-12


@dataclass(frozen=True)
class NmfModel:
    """`topics` has one row per term with columns h0..h(k-1), `docs` one per document (w0..)."""

    topics: DataFrame
    docs: DataFrame
    k: int
    row_id: str
    losses: tuple[float, ...]


def _error(loss: float) -> float:
    return max(loss, 0.0) ** 0.5


def _names(letter: str, k: int) -> list[str]:
    return [f"{letter}{j}" for j in range(k)]


def unit_hash(key: Column, j: int, seed: int) -> Column:
    """A number in (0, 1) fixed by key, component and seed."""
    digest = F.md5(F.concat_ws("#", key.cast("string"), F.lit(str(j)), F.lit(str(seed))))
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return (high + 0.5) / 4294967296.0


def _products(df: DataFrame, letter: str, k: int, *more: Column) -> tuple[np.ndarray, list[float]]:
    """The k x k matrix of sums of products of the columns, and the sums `more`."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cells = [F.sum(F.col(f"{letter}{i}") * F.col(f"{letter}{j}")) for i, j in pairs]
    sums = [float(v or 0.0) for v in df.agg(*cells, *more).first()]
    out = np.zeros((k, k))
    for (i, j), value in zip(pairs, sums):
        out[i, j] = out[j, i] = value
    return out, sums[len(pairs):]


def _weighted_sums(cells: DataFrame, key: str, letter: str, k: int) -> DataFrame:
    return cells.groupBy(key).agg(
        *[F.sum(F.col("cnt") * F.col(f"{letter}{j}")).alias(f"num{j}") for j in range(k)]
    )


def fit_nmf(
    bow: DataFrame, row_id: str, k: int = 5, max_rounds: int = 200, seed: int = 42, tol: float = 1e-4
) -> NmfModel:
    """Factor (row_id, term, cnt) into document and term weights of k topics.

    Rounds go on until the error (the root of the loss) falls by less than `tol` times the first
    round's error, or `max_rounds` are done. `bow` is read twice, so a stored table suits best.
    While the terms are few (measured), documents are kept as one row each and the weights of the terms are sent to the tasks, which
    add up batch by batch; else these stay a table, and blocks of documents look each of their terms up once a round.
    Each round's tables go when the next are written.
    """
    from newsloom.operators import nmf

    numbered = nmf.numbered_terms(bow)
    n_terms = numbered.count()
    if n_terms <= BROADCAST_ROWS:
        dense, numbered = nmf.pack_documents(bow, row_id, numbered)
        return _fit_held(dense, numbered, n_terms, row_id, k, max_rounds, seed, tol)
    return _fit_blocks(bow, numbered, n_terms, row_id, k, max_rounds, seed, tol)


def _fit_blocks(bow: DataFrame, terms: DataFrame, n_terms: int, row_id: str, k: int, max_rounds: int, seed: int, tol: float) -> NmfModel:
    """`fit_nmf` with the weights of the terms in a table; a round is one pass over blocks of documents.

    What a block makes of its documents' weights comes back to it with the values of its terms, as rows of further places.
    """
    from newsloom.operators import nmf

    packed = nmf.documents_of(bow, row_id, terms)
    of_blocks = nmf.blocked(packed).select("block", F.posexplode("ids").alias("place", row_id))
    total, squares = bow.where(F.col("term").isNotNull()).agg(F.sum("cnt"), F.sum(F.col("cnt") * F.col("cnt"))).first()
    n_docs = of_blocks.count()
    if not n_docs:
        raise ValueError("no document has a term")
    scale = float((total / (n_docs * n_terms) / k) ** 0.5)
    start = lambda key: F.array(*[unit_hash(F.col(key), j, seed) * scale for j in range(k)]).alias("v")
    h = nmf.Kept(packed, terms.where(F.col("term").isNotNull()).select("term_id", start("term")), k)
    weights, before, losses = nmf.block_weights(of_blocks.select("block", "place", start(row_id)), k), None, []
    hht = h.sums(nmf._gram)
    for _ in range(max_rounds):
        num, wtw, weights = h.stepped(lambda w, x, g=hht: w * x / (w @ g + EPS), weights)
        h_before, h = h, h.map(lambda v, n, g=wtw: v * n / (v @ g + EPS), num)
        # |X - WH|^2 = |X|^2 - 2 <W'X, H> + <W'W, HH'>
        told = h.sums(lambda v, n: np.append(nmf._gram(v).ravel(), (v * n).sum()), num)
        hht = told[:-1].reshape(k, k)
        losses.append(float(squares) - 2 * float(told[-1]) + float((wtw * hht).sum()))
        released(h_before.rows)
        if before is not None:
            released(before)
        before = num.holder
        if len(losses) > 1 and _error(losses[-2]) - _error(losses[-1]) < tol * _error(losses[0]):
            break
    columns = lambda letter: [F.get("v", F.lit(j)).alias(f"{letter}{j}") for j in range(k)]
    docs = stored(of_blocks.join(nmf.document_weights(weights, k), ["block", "place"]).select(row_id, *columns("w")), "weights")
    named = stored(terms.join(h.table(), "term_id").select("term", *columns("h")), "topics")
    if before is not None:
        released(before)
    released(h.rows)
    return NmfModel(named, docs, k, row_id, tuple(losses))


def _fit_held(packed: DataFrame, terms: DataFrame, n_terms: int, row_id: str, k: int, max_rounds: int, seed: int, tol: float) -> NmfModel:
    """`fit_nmf` with the weights of the terms in memory; a document's weights lie beside its cells."""
    from newsloom.operators.nmf import _lists, _rows, add_up, times_topics

    total, squares, n_docs = packed.agg(
        F.sum(F.aggregate("counts", F.lit(0.0), lambda s, c: s + c)), F.sum(F.aggregate("counts", F.lit(0.0), lambda s, c: s + c * c)), F.count(F.lit(1))
    ).first()
    if not n_docs:
        raise ValueError("no document has a term")
    scale = float((total / (n_docs * n_terms) / k) ** 0.5)
    start = lambda key: F.array(*[unit_hash(F.col(key), j, seed) * scale for j in range(k)])
    h = _rows(terms.select("term_id", start("term").alias("v")).orderBy("term_id").toArrow().column("v").combine_chunks(), k)
    docs = packed.withColumn("w", start(row_id))
    schema = ", ".join(f"{n} {kind}" for n, kind in docs.dtypes)
    context, before, losses = packed.sparkSession.sparkContext, None, []
    for _ in range(max_rounds):
        hht, columns = h.T @ h, context.broadcast(h.T.copy())

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = _rows(batch.column("w"), k)
                w = w * times_topics(batch, columns.value) / (w @ hht + EPS)  # noqa: B023
                yield batch.set_column(batch.schema.get_field_index("w"), "w", _lists(w))

        def weigh(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            w = _rows(batch.column("w"), k)
            return w, (w.T @ w).ravel()

        docs = stored(docs.mapInArrow(update, schema), "documents-with-weights")
        num, wtw = add_up(docs.select("term_ids", "counts", "w"), n_terms, weigh, k, k * k)
        wtw = wtw.reshape(k, k)
        h = h * num / (h @ wtw + EPS)
        columns.unpersist()
        if before is not None:
            released(before)
        before = docs
        # |X - WH|^2 = |X|^2 - 2 <W'X, H> + <W'W, HH'>
        losses.append(float(squares) - 2 * float((num * h).sum()) + float((wtw * (h.T @ h)).sum()))
        if len(losses) > 1 and _error(losses[-2]) - _error(losses[-1]) < tol * _error(losses[0]):
            break
    weights = stored(docs.select(row_id, *[F.get("w", F.lit(j)).alias(f"w{j}") for j in range(k)]), "weights")
    released(docs), released(packed)
    values = pa.table({"term_id": pa.array(np.arange(n_terms)), **{f"h{j}": pa.array(h[:, j]) for j in range(k)}})
    named = terms.join(packed.sparkSession.createDataFrame(values), "term_id").select("term", *_names("h", k))
    return NmfModel(named, weights, k, row_id, tuple(losses))


def transform_nmf(model: NmfModel, bow: DataFrame, max_rounds: int = 1000, tol: float = 1e-6) -> DataFrame:
    """(row_id, topic, loading) of documents under fixed topics.

    A document's updates end when none changes its weights by more than `tol` of the largest. With the topics fixed, X H' and H H' are too, so one pass gives
    all that the updates of a document need; they then run row by row, in Arrow batches. Topics of many terms are looked up by blocks of documents.
    """
    from newsloom.operators import nmf

    k, row_id = model.k, model.row_id
    hht, _ = _products(model.topics, "h", k)

    def settled(numerator: np.ndarray) -> np.ndarray:
        weight = np.ones_like(numerator)
        moving = np.arange(len(weight))
        for _ in range(max_rounds):
            old = weight[moving]
            new = old * numerator[moving] / (old @ hht + EPS)
            weight[moving] = new
            moving = moving[np.abs(new - old).max(1, initial=0) > tol * np.abs(new).max(1, initial=0)]
            if not len(moving):
                break
        return weight

    if not is_small(model.topics):
        packed = vars(bow).get("documents", {}).get(row_id)
        packed = nmf.documents_of(bow, row_id, nmf.numbered_terms(bow)) if packed is None else packed
        values = packed.named.join(model.topics, "term").select("term_id", F.array(*_names("h", k)).alias("v"))
        docs = nmf.Kept(packed, values, k).weights(settled, row_id, known_only=True)
        return loadings(docs.select(row_id, *[F.get("v", F.lit(j)).alias(f"w{j}") for j in range(k)]), row_id, k)
    cells = bow.join(F.broadcast(model.topics), ["term"])
    sums = _weighted_sums(cells, row_id, "h", k)
    kind = dict(bow.dtypes)[row_id]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weight = settled(batch[[f"num{j}" for j in range(k)]].to_numpy())
            yield pd.DataFrame({row_id: batch[row_id], **{f"w{j}": weight[:, j] for j in range(k)}})

    solved = sums.mapInPandas(solve, f"{row_id} {kind}, " + ", ".join(f"{n} double" for n in _names("w", k)))
    return loadings(solved, row_id, k)


def loadings(docs: DataFrame, row_id: str, k: int) -> DataFrame:
    """Wide document weights as (row_id, topic, loading)."""
    entries = F.array(
        *[F.struct(F.lit(j).alias("topic"), F.col(f"w{j}").alias("loading")) for j in range(k)]
    )
    return docs.select(row_id, F.explode(entries).alias("e")).select(row_id, "e.topic", "e.loading")


def assign_topic(weights: DataFrame, row_id: str) -> DataFrame:
    """(row_id, topic): the topic with the largest loading, the lowest one on a tie."""
    return weights.groupBy(row_id).agg(
        F.max_by("topic", F.struct(F.col("loading"), -F.col("topic"))).alias("topic")
    )


def name_topics(model: NmfModel, n: int = 4) -> DataFrame:
    """(topic, name): a topic's heaviest terms joined by '_'."""
    entries = F.array(
        *[F.struct(F.lit(j).alias("topic"), F.col(f"h{j}").alias("load")) for j in range(model.k)]
    )
    long = model.topics.select("term", F.explode(entries).alias("e")).select("term", "e.topic", "e.load")
    heavy = top_n_per_group(long, ["topic"], [F.desc("load"), "term"], n)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("load")).alias("order"), "term")))
    return heavy.groupBy("topic").agg(
        F.array_join(F.transform(ordered, lambda p: p["term"]), "_").alias("name")
    )


def label_topics(df: DataFrame, col: str, model: NmfModel, weights: DataFrame) -> DataFrame:
    """Add `topic`, the name of each row's strongest topic; null where the text is null.

    A text without any term has no loading at all and goes to the lowest topic.
    """
    names = name_topics(model)
    lowest = names.where(F.col("topic") == 0).select("name").scalar()
    named = assign_topic(weights, model.row_id).join(F.broadcast(names), "topic")
    topic = F.when(F.col(col).isNotNull(), F.coalesce("name", lowest))
    return (
        df.join(named.select(model.row_id, "name"), model.row_id, "left")
        .withColumn("topic", topic)
        .drop("name")
    )
