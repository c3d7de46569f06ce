"""Centroid clustering by a tournament of bisectors (operator 11).

Vectors and centroids are integers, so every test is exact. For each two centroids a < b the plane halfway
between them has the integer normal 2 (b - a) and the threshold |b|^2 - |a|^2: a vector lies nearer to b where
normal . x is larger than that. The centroids meet one after the other; the winner so far meets the next, and on
the plane itself the smaller number stays. So k - 1 signs name the nearest centroid, and only its distance is
computed. The table of planes has k * k * dimensions numbers, which k and the dimension bound.

A round sends, for each task, one row per centroid and dimension; sums meet by those, so that no group is
larger than the number of tasks. Rounds read the integers from a stored table, which outlives executors.

Cases: a vector that is null, has another length, or holds a null or non-finite entry is left out; integers are
clipped to +-2^26, which keeps all arithmetic inside 64 bits (sums of distances end at 2^63 - 1); a null id counts as
empty text in the starting order, and equal ids follow the order of their integers; equal vectors share a cluster;
equal distances go to the smaller number; with fewer vectors than centroids each vector starts one; an empty table
gives no rows; very long texts in other columns are carried along; extra columns stay, those of the outputs' names
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import unused
from newsloom.llm.registry import query, table
from newsloom.session import stored

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LIMIT = 1 << 26
MOST = (1 << 63) - 1
ROWS_AT_ONCE = 4096


def whole_rows(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows hold `length` finite numbers, the matrix of those rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    keep = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(column), length), False))
    values = column.filter(pa.array(keep)).flatten()
    matrix = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length) if length else np.zeros((int(keep.sum()), 0))
    # A null entry has become NaN.
    good = np.isfinite(matrix).all(1)
    rows = np.flatnonzero(keep)
    keep = keep.copy()
    keep[rows[~good]] = False
    return keep, matrix[good]


def integer_vectors(vectors: DataFrame, column: str, name: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """The other columns of the rows kept, and their vectors as integers floor(scale * x) in column `name`."""
    others = [f for f in vectors.schema.fields if f.name != column]
    schema = T.StructType([*others, T.StructField(name, T.ArrayType(T.LongType()))])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = whole_rows(batch.column(column), dimensions)
            with np.errstate(over="ignore"):
                ints = np.clip(np.floor(scale * x), -LIMIT, LIMIT).astype(np.int64)
            rows = batch.filter(pa.array(keep))
            ends = pa.array(np.arange(0, ints.size + 1, dimensions) if len(ints) else [0], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(ints.ravel()))
            yield pa.RecordBatch.from_arrays([*[rows.column(f.name) for f in others], lists], [*[f.name for f in others], name])

    return vectors.select(*[f.name for f in others], F.col(column).cast("array<double>").alias(column)).mapInArrow(convert, schema)


class Bisectors:
    """The planes between every two of some integer centroids."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        sizes = (centroids * centroids).sum(1)
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = sizes[None, :] - sizes[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; the smaller one on a tie."""
        best = np.zeros(len(x), np.int64)
        for at in range(0, len(x), ROWS_AT_ONCE):
            rows, won = x[at : at + ROWS_AT_ONCE], best[at : at + ROWS_AT_ONCE]
            for b in range(1, len(self.centroids)):
                side = np.einsum("ij,ij->i", rows, self.normals[won, b]) - self.thresholds[won, b]
                won[side > 0] = b
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return np.einsum("ij,ij->i", apart, apart)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimensions)


def cluster_sums(ints: DataFrame, name: str, planes: Bisectors) -> tuple[np.ndarray, np.ndarray]:
    """(vectors in each cluster, componentwise sums) for the clusters of `planes`."""
    k, dimensions = planes.centroids.shape
    shared = ints.sparkSession.sparkContext.broadcast(planes)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = shared.value, np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(name), dimensions)
            best = own.nearest(x)
            order = np.argsort(best, kind="stable")
            met, begins = np.unique(best[order], return_index=True)
            if len(met):
                sums[met, 1:] += np.add.reduceat(x[order], begins, 0)
                sums[met, 0] += np.diff(np.append(begins, len(x)))
        cluster, place = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(sums[cluster, place])], ["cluster", "place", "total"])

    parts = ints.select(name).mapInArrow(add, "cluster int, place int, total bigint")
    out = np.zeros((k, dimensions + 1), np.int64)
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
        out[r["cluster"], r["place"]] = r["total"]
    shared.unpersist()
    return out[:, 0], out[:, 1:]


def starting_order(id_column: str) -> Column:
    return F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)


def fit(ints: DataFrame, name: str, id_column: str, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after `rounds` rounds, as integers; `ints` is read once a round."""
    first = ints.select(starting_order(id_column).alias("order"), name).orderBy("order", name).limit(k).collect()
    centroids = np.array([r[name] for r in first], np.int64).reshape(len(first), len(first[0][name]) if first else 0)
    for _ in range(rounds if len(centroids) else 0):
        n, sums = cluster_sums(ints, name, Bisectors(centroids))
        met = n > 0
        centroids[met] = sums[met] // n[met, None]
    return centroids


def assigned(ints: DataFrame, name: str, centroids: np.ndarray) -> DataFrame:
    """The other columns of `ints` with `cluster` and `distance` (squared) of the nearest centroid."""
    added = [T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    others = [f for f in ints.schema.fields if f.name not in (name, "cluster", "distance")]
    shared = ints.sparkSession.sparkContext.broadcast(Bisectors(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = _matrix(batch.column(name), own.centroids.shape[1])
            best = own.nearest(x)
            arrays = [pa.array(best, pa.int32()), pa.array(own.distances(x, best))]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], *arrays], [*[f.name for f in others], "cluster", "distance"])

    return ints.select(*[f.name for f in others], name).mapInArrow(assign, T.StructType([*others, *added]))


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(the rows kept, without their vector, with `cluster` and `distance`; the final centroids)."""
    name = unused(vectors, "integers")
    ints = stored(integer_vectors(vectors, column, name, dimensions, scale), "integer-vectors")
    centroids = fit(ints, name, id_column, k, rounds)
    return stored(assigned(ints, name, centroids), "clusters"), centroids


def _sql() -> str:
    """The rounds written out for DuckDB."""
    apart = "list_sum([(u[1] - u[2]) * (u[1] - u[2]) FOR u IN list_zip(k.x, c.x)])"
    parts = [
        """kept AS (SELECT row_number() OVER () AS rn, vec_id, [CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS x
 FROM embeddings WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(CAST(e AS DOUBLE))]) = 0)""",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM kept QUALIFY c < 16)",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"a{r} AS (SELECT k.rn, any_value(k.vec_id) AS vec_id, any_value(k.x) AS x, min({{'d': CAST({apart} AS BIGINT), 'c': c.c}}) AS b FROM kept k, c{r} c GROUP BY k.rn)")
        if r < ROUNDS:
            parts.append(f"e{r} AS (SELECT b.c AS c, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM a{r})")
            parts.append(f"s{r} AS (SELECT c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM e{r} GROUP BY c, i)")
            parts.append(f"m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY c)")
            parts.append(f"c{r + 1} AS (SELECT o.c, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.b.c AS INTEGER) AS cluster, a.b.d AS distance,
 CAST(sum(a.b.d) OVER (PARTITION BY a.b.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia,
 sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.b.c"""


@query("op11_centroid_clusters", _sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = {r["cluster"]: int(r["total"]) for r in rows.groupBy("cluster").agg(total.alias("total")).collect()}
    of = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1) if len(values) else F.lit(None).cast(kind)
    return rows.select(
        "vec_id", "cluster", "distance",
        of([min(MOST, per.get(c, 0)) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(min(MOST, sum(per.values()))).cast("bigint").alias("inertia"),
        F.sha2(of([",".join(map(str, c.tolist())) for c in centroids], "string"), 256).alias("centroid_sha256"),
    )
