"""Quality classifier: ridge regression on random Fourier features, calibrated (operator 5).

Statistics of a whole text (shares of kinds of characters, lengths of words and lines, repetition) are standardised and sent through cos(w x + b) with fixed
random w and b, so that inner products approximate a Gaussian kernel. Tasks add up their part of
the normal equations; one small system is solved. Isotonic regression on rows the solution was not fitted to
turns its values into probabilities.

At most `MAX_ROWS` labelled rows are learned from, chosen by a hash of the id; what is gathered has the
size of the feature matrix, whatever the input.

Cases: a text of any length is measured whole; documents of equal statistics score alike; null or empty text has all statistics 0 and is scored like any other; null labels are left out and
repeated labels count by their mean (at least a half: 1); without labelled rows of both kinds every score is
the share of good labels (or 0.5); repeated rows score alike; an empty table gives no rows; extra columns
stay, those of the outputs' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import fold
from newsloom.llm.language import byte_chunks
from newsloom.llm.registry import query, table
from newsloom.session import stored

MAX_ROWS = 40_000
FEATURES = 300
WIDTH = 2.5
RIDGE = 1e-3
ACCEPT = 0.3
STEPS = 512

#: Kinds of bytes: their shares are statistics.
KINDS = {
    "upper": [range(65, 91)],
    "lower": [range(97, 123)],
    "digit": [range(48, 58)],
    "blank": [range(32, 33), range(9, 14)],
    "stop": [b"!.?"],
    "pause": [b",;:"],
    "bar": [b"|"],
    "symbol": [b"#*$%&<>@^~_+=/\\{}[]"],
    "quote": [b"\"'()-`"],
    "control": [range(0, 9), range(14, 32), range(127, 128)],
    "high": [range(128, 256)],
}
KIND = np.full(256, len(KINDS), np.int64)
for _at, _sets in enumerate(KINDS.values()):
    for _s in _sets:
        KIND[list(_s)] = _at
STATISTICS = [*KINDS, "log_bytes", "word_length", "word_spread", "long_words", "distinct_words", "line_words", "distinct_lines", "same_as_before"]


def _distinct(keys: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """How many different keys each owner has."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=rows)


MIX = np.uint64(0x9E3779B97F4A7C15)


def _spans(gap: np.ndarray, data: np.ndarray, owner: np.ndarray):
    """(start, end, owner, key) of runs without gaps inside one text; keys tell runs apart."""
    edge = np.ones(len(gap) + 1, bool)
    edge[1:-1] = gap[1:] | gap[:-1] | (owner[1:] != owner[:-1])
    start = np.flatnonzero(edge[:-1] & ~gap)
    if not len(start):
        return start, start, start, start.astype(np.uint64)
    ends = np.flatnonzero(edge[1:] & ~gap) + 1
    with np.errstate(over="ignore"):
        place = np.arange(len(data), dtype=np.uint64) - np.repeat(start, np.diff(np.append(start, len(data)))).astype(np.uint64) if start[0] == 0 else None
        if place is None:
            from_start = np.zeros(len(data), np.int64)
            from_start[start] = 1
            run = np.maximum(np.cumsum(from_start) - 1, 0)
            place = (np.arange(len(data)) - start[run]).astype(np.uint64)
        value = (data.astype(np.uint64) + np.uint64(1)) * ((place + np.uint64(1)) * MIX ^ (place * MIX >> np.uint64(29)))
        value[gap] = 0
        key = np.add.reduceat(value, start)
    return start, ends, owner[start], key


def statistics(column: pa.Array) -> np.ndarray:
    """The statistics of each text (texts x STATISTICS)."""
    out = np.zeros((len(column), len(STATISTICS)))
    for at, rows, data, offsets in byte_chunks(column):
        n = np.diff(offsets)
        owner = np.repeat(np.arange(rows), n)
        size = np.maximum(1, n)
        kinds = np.bincount(owner * (len(KINDS) + 1) + KIND[data], minlength=rows * (len(KINDS) + 1)).reshape(rows, -1)
        here = out[at : at + rows]
        here[:, : len(KINDS)] = kinds[:, :-1] / size[:, None]
        blank = KIND[data] == list(KINDS).index("blank")
        start, end, own, key = _spans(blank, data, owner)
        words = np.maximum(1, np.bincount(own, minlength=rows))
        length = (end - start).astype(float)
        mean = np.bincount(own, length, rows) / words
        again = np.zeros(len(key))
        if len(key):
            again[1:] = (key[1:] == key[:-1]) & (own[1:] == own[:-1])
        _, _, line_own, line_key = _spans(data == 10, data, owner)
        lines = np.maximum(1, np.bincount(line_own, minlength=rows))
        here[:, len(KINDS) :] = np.stack(
            [
                np.log1p(n),
                mean,
                np.sqrt(np.maximum(0, np.bincount(own, length**2, rows) / words - mean**2)),
                np.bincount(own, length > 20, rows) / words,
                _distinct(key, own, rows) / np.sqrt(words),
                np.log1p(words / lines),
                _distinct(line_key, line_own, rows) / lines,
                np.bincount(own, again, rows) / words,
            ],
            1,
        )
        here[n == 0] = 0
    return out


class Fourier:
    """Standardised statistics to cosines of fixed random projections."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, width: float = WIDTH) -> None:
        rng = np.random.default_rng(5)
        self.mean, self.scale = mean, 1 / np.where(spread > 0, spread, 1)
        self.w = rng.normal(size=(len(mean), features)) / (width * np.sqrt(len(mean) / 4))
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        return np.concatenate([np.ones((len(x), 1)), np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)], 1)


def isotonic(value: np.ndarray, good: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing means closest to good / weight, for values in ascending order (pool adjacent violators)."""
    pools: list[list[float]] = []
    for g, w in zip(good.tolist(), weight.tolist()):
        pools.append([g, w, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g2, w2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + w2, pools[-1][2] + n2]
    return np.concatenate([np.full(int(n), g / w) for g, w, n in pools]) if pools else np.zeros(0)


class Model:
    def __init__(self, fourier: Fourier | None, weights: np.ndarray | None, knots: np.ndarray, chances: np.ndarray) -> None:
        self.fourier, self.weights, self.knots, self.chances = fourier, weights, knots, chances

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.chances[0])
        raw = self.fourier(x) @ self.weights
        # The raw value decides between rows of one pool, without changing sides of any threshold that matters.
        return np.clip(0.98 * np.interp(raw, self.knots, self.chances) + 0.02 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text, with `x`, the statistics of the whole text."""
    others = [f for f in docs.schema.fields if f.name != text]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(text))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], pa.array(list(x), pa.list_(pa.float64()))], [*[f.name for f in others], "x"])

    return docs.select(*[f.name for f in others], text).mapInArrow(measure, T.StructType([*others, T.StructField("x", T.ArrayType(T.DoubleType()))]))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, part) -> np.ndarray:
    """The sum over tasks of `part`(x, y), a matrix; one row of it at a time moves and is added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_matrix(batch), np.asarray(batch.column("good"), np.float64))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    def join(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = np.asarray(group.column("row").combine_chunks().flatten()).reshape(group.num_rows, -1)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": pa.array([rows.sum(0)], pa.list_(pa.float64()))})

    summed = rows.select("x", "good").mapInArrow(add, "i int, row array<double>").groupBy("i").applyInArrow(join, "i int, row array<double>").collect()
    return np.array([r["row"] for r in sorted(summed, key=lambda r: r["i"])])


def train(rows: DataFrame) -> Model:
    """Learn from `rows` (x, good: 0 or 1, fitted: whether for the equations or the calibration)."""
    seen = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return Model(None, None, np.zeros(1), np.array([1.0 if 1 in seen else 0.0 if seen else 0.5]))
    moments = _summed(rows, lambda x, y: np.stack([np.full(x.shape[1], len(x)), x.sum(0), (x**2).sum(0)]))
    mean = moments[1] / moments[0]
    fourier = Fourier(mean, np.sqrt(np.maximum(0, moments[2] / moments[0] - mean**2)))
    # Both kinds of label weigh alike in the equations; the calibration brings the real shares back.
    weight = {k: sum(seen.values()) / (2 * n) for k, n in seen.items()}

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x)
        heavy = z * np.where(y == 1, weight[1], weight[0])[:, None]
        return np.concatenate([heavy.T @ z, (heavy.T @ y)[:, None]], 1)

    sums = _summed(rows.where("fitted"), equations)
    if not len(sums):
        return Model(None, None, np.zeros(1), np.array([seen[1] / sum(seen.values())]))
    solved = np.linalg.solve(sums[:, :-1] + RIDGE * sum(seen.values()) / 2 * np.eye(len(sums)) / FEATURES, sums[:, -1])
    edges = np.linspace(-0.5, 1.5, STEPS + 1)

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(edges, fourier(x) @ solved, side="right") - 1, 0, STEPS - 1)
        return np.stack([np.bincount(at, minlength=STEPS), np.bincount(at, y, STEPS)]).astype(float)

    counts = _summed(rows.where("not fitted"), histogram)
    if not len(counts):
        counts = _summed(rows, histogram)
    used = np.flatnonzero(counts[0])
    chances = isotonic(used, counts[1][used], counts[0][used])
    return Model(fourier, solved, ((edges[:-1] + edges[1:]) / 2)[used], chances)


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from the texts of `docs` (doc_id, text) and `labels` (doc_id, quality); leave held-out labels out before.

    About `max_rows` labelled documents are used, so that what is joined and measured is bounded.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    total = known.count()
    place = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20))
    picked = known.where(place < min(1.0, max_rows / max(1, total)) * (1 << 20))
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"))
    return train(stored(rows.select("x", "good", (F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(4)) > 0).alias("fitted")), "quality-rows"))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` and `predicted` of its whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*others, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(statistics(batch.column(text)))
            arrays = [pa.array(score), pa.array((score >= ACCEPT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], *arrays], [*[f.name for f in others], "score", "predicted"])

    return docs.select(*[f.name for f in others]).mapInArrow(judge, schema)


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(fold("doc_id", 5) != 0))
    told = scored(docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "score", "predicted")
