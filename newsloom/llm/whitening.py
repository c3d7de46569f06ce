"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 13).

The centred rows X are never multiplied into a covariance. From a fixed random direction, products X v and
X' u alternate: a step takes the next left vector u = X v - (its parts along earlier ones) and the next right vector
v = X' u - (its parts along earlier ones), so that X V = U B with a small upper bidiagonal B. All earlier vectors are taken out
of each new one, by sums over the whole table for the left vectors, whenever much is cancelled a second time. The
singular vectors of B, turned by V, are the components, and its singular values their deviations.

A left vector has a number per row of the table. It is not stored: it is X p for a vector p of one number per
dimension, so a task makes the left vectors of its rows anew, and a lost executor costs only its tasks. One job a
step does both products: X'u follows from X'(X v) and the X'u of earlier steps, since u is a sum of X v and earlier left
vectors. What moves is one row per task and number; rows are read from blocks of packed integers.

By default the steps go through all dimensions, which makes the result exact also for repeated singular values;
`steps` bounds them for very wide tables, `residuals` then says how good each component is. Where a direction
ends early (rank, repeated values), a new random one that is orthogonal to all before goes on.

Integers x = floor(scale * c) + shift are centred as (n x - S) / n with the division last, so nothing is lost by the shift.

Cases: a null vector and one with a null or non-finite entry are left out, and so are vectors of another length than
most have (of the larger one on a tie); repeated rows count as often as they occur; integers are clipped to +-2^31;
deviations end at 2^63 - 1; a component without deviation (beyond the rank; one row; an empty table) cannot be whitened
and is not returned, so such a table gives no rows; ties between deviations are broken by the arithmetic, alike for all
rows; very long texts in other columns are carried along; extra columns stay, those of the outputs' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.centroids import whole_rows
from newsloom.llm.registry import query, table
from newsloom.session import stored

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LIMIT = 1 << 31
MOST = (1 << 63) - 1
BLOCK_ROWS = 4096
#: A singular value below this share of the largest counts as none.
RANK = 1e-9
#: Where less than this share of a vector's square is left, parts along earlier vectors are taken out again.
CANCELLED = 0.1


def as_integers(x: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x) + shift, -LIMIT, LIMIT).astype(np.int64)


def blocks_of(vectors: DataFrame, column: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(dimensions, n, packed): up to BLOCK_ROWS vectors of one length as little-endian 64-bit integers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                lists = batch.column(column).slice(at, BLOCK_ROWS)
                for length in pc.unique(pc.list_value_length(lists)).to_pylist():
                    if length is None:
                        continue
                    x = as_integers(whole_rows(lists, length)[1], scale, shift)
                    if len(x):
                        row = [pa.array([length], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([x.astype("<i8").tobytes()], pa.binary())]
                        yield pa.RecordBatch.from_arrays(row, ["dimensions", "n", "packed"])

    return vectors.select(F.col(column).cast("array<double>").alias(column)).mapInArrow(pack, "dimensions int, n bigint, packed binary")


@dataclass
class Centred:
    """The rows of stored blocks less their mean; sums over them are taken task by task."""

    blocks: DataFrame
    n: int
    sums: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Integers as centred numbers."""
        return (self.n * x - self.sums) / self.n

    def total(self, part, size: int) -> np.ndarray:
        """The sum over all blocks of `part`(centred rows), `size` numbers; a task sends one row per number."""
        own, dimensions = self.rows, len(self.sums)
        kernel = part

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for packed in batch.column("packed"):
                    out += kernel(own(np.frombuffer(packed.as_buffer(), "<i8").reshape(-1, dimensions)))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(out)], ["i", "total"])

        summed = self.blocks.select("packed").mapInArrow(add, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
        out = np.zeros(size)
        for r in summed:
            out[r["i"]] = r["total"]
        return out

    def __getstate__(self) -> dict:
        return {"blocks": None, "n": self.n, "sums": self.sums}


def centred(blocks: DataFrame) -> Centred | None:
    """The rows of the commonest length, centred; None without rows."""
    sizes = blocks.groupBy("dimensions").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dimensions")).limit(1).collect()
    if not sizes or not sizes[0]["dimensions"]:
        return None
    dimensions, n = sizes[0]["dimensions"], sizes[0]["n"]
    own = blocks.where(F.col("dimensions") == dimensions)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(dimensions, np.int64)
        for batch in batches:
            for packed in batch.column("packed"):
                out += np.frombuffer(packed.as_buffer(), "<i8").reshape(-1, dimensions).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(out)], ["i", "total"])

    sums = np.zeros(dimensions, np.int64)
    for r in own.select("packed").mapInArrow(add, "i int, total bigint").groupBy("i").agg(F.sum("total").alias("total")).collect():
        sums[r["i"]] = r["total"]
    return Centred(own, n, sums)


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """`vector` without its parts along the columns of `basis`; twice is enough."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(rows: Centred, steps: int | None = None, seed: int = 13) -> tuple[np.ndarray, np.ndarray, float]:
    """(V, B, last): right vectors as columns, the upper bidiagonal matrix with X V = U B, and the coupling left over."""
    d = len(rows.sums)
    steps = min(d, steps or d)
    rng = np.random.default_rng(seed)
    fresh = lambda basis: (lambda r: r / np.linalg.norm(r))(_orthogonal(rng.normal(size=d), basis))
    right, made, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    b = np.zeros((steps, steps))
    v, scale, coupling = fresh(right), 0.0, 0.0
    for j in range(steps):
        right = np.column_stack([right, v])

        def products(direction: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            """|w|^2, U'w and X'w of w = X direction."""
            earlier = made

            def part(x: np.ndarray) -> np.ndarray:
                w = x @ direction
                return np.concatenate([[w @ w], (x @ earlier).T @ w, x.T @ w])

            out = rows.total(part, 1 + j + d)
            return out[0], out[1 : 1 + j], out[1 + j :]

        square, along, pulled = products(v)
        scale = max(scale, square**0.5)
        p, z, left = v - made @ along, pulled - back @ along, square - along @ along
        if left < CANCELLED * square:
            square, along, pulled = products(p)
            p, z, left = p - made @ along, pulled - back @ along, square - along @ along
        alpha = max(left, 0.0) ** 0.5
        if alpha <= RANK * scale:
            # X v is made of earlier left vectors: there is no new one.
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            p, z = p / alpha, z / alpha
        made, back = np.column_stack([made, p]), np.column_stack([back, z])
        b[j, j] = alpha
        if right.shape[1] == d:
            coupling = 0.0
            break
        rest = _orthogonal(z, right)
        coupling = float(np.linalg.norm(rest))
        if coupling <= RANK * scale:
            coupling, v = 0.0, fresh(right)
        else:
            v = rest / coupling
        if j + 1 < steps:
            b[j, j + 1] = coupling
    return right, b, coupling


@dataclass
class Whitening:
    """Components as columns, the variances along them, and what they were fitted to."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((self.n * x - self.sums) / self.n) @ (self.components / np.sqrt(self.variances))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums over dimensions of (n x - S)^2, exact up to 2^63 - 1."""
        n = self.n
        if n * LIMIT < 1 << 62:
            apart = n * x - self.sums
            if not len(apart) or float((apart.astype(np.float64) ** 2).sum(1).max()) < 2.0**62:
                return np.einsum("ij,ij->i", apart, apart)
        apart = n * x.astype(object) - self.sums.astype(object)
        return np.array([min(MOST, int(s)) for s in (apart * apart).sum(1)], np.int64)


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, steps: int | None = None, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The first components of all usable vectors; None if there is none with a deviation."""
    rows = centred(stored(blocks_of(vectors, column, scale, shift), "vector-blocks"))
    if rows is None:
        return None
    trace = float(rows.total(lambda x: np.array([(x * x).sum()]), 1)[0]) / rows.n
    right, b, coupling = bidiagonalise(rows, steps)
    left_small, sigma, right_small = np.linalg.svd(b)
    known = min(components, int((sigma > RANK * sigma[0]).sum())) if sigma[0] > 0 else 0
    if not known:
        return None
    residuals = coupling * np.abs(left_small[-1, :known]) / sigma[:known]
    made = Whitening(rows.n, rows.sums, right @ right_small[:known].T, sigma[:known] ** 2 / rows.n, trace, residuals)
    turn = made.components / np.sqrt(made.variances)
    mean = rows.total(lambda x: (x @ turn).sum(0), known) / rows.n

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ turn - mean
        return (y.T @ y).ravel()

    covariance = rows.total(products, known * known).reshape(known, known) / rows.n
    made.identity_error = float(np.abs(covariance - np.eye(known)).max())
    return made


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The other columns of all usable rows with `whitened` (one number a component) and `deviation`."""
    added = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    others = [f for f in vectors.schema.fields if f.name not in (column, "whitened", "deviation")]
    names = [f.name for f in others]
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            keep, x = whole_rows(batch.column(column), len(own.sums))
            ints, rows = as_integers(x, scale, shift), batch.filter(pa.array(keep))
            out = own.whitened(ints)
            ends = pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32())
            arrays = [pa.ListArray.from_arrays(ends, pa.array(out.ravel())), pa.array(own.deviations(ints))]
            yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in names], *arrays], [*names, "whitened", "deviation"])

    return vectors.select(*names, F.col(column).cast("array<double>").alias(column)).mapInArrow(turn, T.StructType([*others, *added]))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.variances])
    return rows.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("place") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
