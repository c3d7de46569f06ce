"""Topics fitted until they settle: a start from singular vectors, then exact alternating least squares.

The start is NNDSVD (Boutsidis & Gallopoulos, 2008): the leading singular vectors of the bag of words, from a
randomised range finder (Halko, Martinsson & Tropp, 2011), split in their positive and negative parts. Each half
of a round then solves non-negative least squares by cyclic coordinate descent (HALS; Cichocki & Phan, 2009) until its block
is optimal. As a document's weights follow from the topics alone, they are never kept between rounds: a round is one
pass over the documents that makes their weights and adds up what the topics need.

Values per term (a row of a few numbers) are held in memory and sent to every task while they are within `held_terms` rows;
beyond, they stay tables of a row for each part of the terms, and blocks of documents look each of their terms up once; what
goes between blocks and parts is one row for both, numbers side by side. Only matrices of k x k
(in the start k + `OVERSAMPLE`) numbers reach the driver otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import BROADCAST_ROWS, lookup_join
from newsloom.operators.ranking import with_sequential_id
from newsloom.operators.tfidf import _changes
from newsloom.operators.topics import NmfModel, loadings
from newsloom.session import bucketed, released, stored

OVERSAMPLE = 8
POWER_ROUNDS = 4
#: Inner sweeps end when no number moves by more than this share of the largest.
SETTLED, MOST_SWEEPS = 1e-10, 2000
#: A round that lowers the error by less than this share of the squared counts has only rounding left to do.
STILL = 1e-13
SUMS = "term_id bigint, v array<double>"
#: Parts of the terms for each of the session's shuffle partitions.
PARTS_A_BUCKET = 2
#: The terms of a part by number and their values, a row a term; what a block wants of a part and finds there; weights of a block's documents.
VALUES, WANTED, FOUND, WEIGHTS = (
    "part bigint, ids binary, v binary", "part bigint, of_block bigint, at binary, ids binary", "of_block bigint, at binary, ids binary, v binary",
    "block bigint, at binary, v binary",
)

Solve = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class FittedNmf(NmfModel):
    """Also the norm of the projected gradient before each round, of which the last is under the tolerance."""

    gradients: tuple[float, ...] = ()


def least_squares(gram: np.ndarray, right: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Rows y >= 0 of least |y A - b|, given gram = A A' and right = b A', by cyclic coordinate descent."""
    k = len(gram)
    y = np.maximum(0.0, right @ np.linalg.pinv(gram)) if start is None else start.copy()
    diagonal = np.diag(gram)
    moving = np.arange(len(y))
    for _ in range(MOST_SWEEPS):
        if not len(moving):
            break
        now, b = y[moving], right[moving]
        before = now.copy()
        for t in range(k):
            if diagonal[t] > 0:
                now[:, t] = np.maximum(0.0, now[:, t] + (b[:, t] - now @ gram[:, t]) / diagonal[t])
        y[moving] = now
        moving = moving[np.abs(now - before).max(1) > SETTLED * np.maximum(np.abs(now).max(1), 1e-300)]
    return y


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(np.ascontiguousarray(values).ravel()))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each cell's document in the batch, term numbers, counts)."""
    lengths = np.asarray(batch.column("term_ids").value_lengths())
    return np.repeat(np.arange(batch.num_rows), lengths), np.asarray(batch.column("term_ids").flatten()), np.asarray(batch.column("counts").flatten(), np.float64)


def add_up(table: DataFrame, n_terms: int, weigh: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(X'W, sums of measures) over documents X in packed rows; `weigh`(batch) gives weights W and `size` measured numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, out = np.zeros(size), None
        for batch in batches:
            doc, term, count = _documents(batch)
            w, measured = weigh(batch)
            total += measured
            sums = np.stack([np.bincount(term, count * w[doc, j], n_terms) for j in range(width)], 1)
            out = sums if out is None else out + sums
        if out is not None:
            met = np.flatnonzero(out.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(met), _lists(out[met])], ["term_id", "v"])
            # What was measured travels as numbers of terms that do not exist.
            yield pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(size)), _lists(np.repeat(total[:, None], width, 1))], ["term_id", "v"])

    parts = table.mapInArrow(add, SUMS)
    got = parts.groupBy("term_id").agg(F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(width)]).alias("v")).toArrow()
    ids, values = np.asarray(got.column("term_id"), np.int64), _rows(got.column("v").combine_chunks(), width)
    out, measured = np.zeros((n_terms, width)), np.zeros(size)
    out[ids[ids >= 0]] = values[ids >= 0]
    measured[-1 - ids[ids < 0]] = values[ids < 0, 0]
    return out, measured


def times_topics(batch: pa.RecordBatch, columns: np.ndarray) -> np.ndarray:
    """X values for the documents of a batch; `columns` holds the values of the terms, a row a column."""
    doc, term, count = _documents(batch)
    return np.stack([np.bincount(doc, count * c[term], batch.num_rows) for c in columns], 1)


class Held:
    """A row of numbers for every term, in memory."""

    def __init__(self, packed: DataFrame, values: np.ndarray) -> None:
        self.packed, self.values = packed, values

    def map(self, fn: Callable[..., np.ndarray], *others: Held) -> Held:
        return Held(self.packed, fn(self.values, *[o.values for o in others]))

    def sums(self, part: Callable[..., np.ndarray], *others: Held) -> np.ndarray:
        """The sum over terms of `part`(rows, ...), numbers that add up over any split of the terms."""
        return part(self.values, *[o.values for o in others])

    def done(self) -> None:
        """Nothing reads these values any more."""

    def product(self, solve: Solve, measure: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[Held, np.ndarray]:
        """(X'W, sums of measure(X values, W)) for weights W = solve(X values) of the documents X."""
        n, q = self.values.shape
        nothing = solve(np.zeros((0, q)))
        shared = self.packed.sparkSession.sparkContext.broadcast(np.ascontiguousarray(self.values.T))

        def weigh(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            x = times_topics(batch, shared.value)
            w = solve(x)
            return w, measure(x, w)

        out, measured = add_up(self.packed.select("term_ids", "counts"), n, weigh, nothing.shape[1], len(measure(np.zeros((0, q)), nothing)))
        shared.unpersist()
        return Held(self.packed, out), measured

    def weights(self, solve: Solve, row_id: str) -> DataFrame:
        """(row_id, v): the weights of every document."""
        shared = self.packed.sparkSession.sparkContext.broadcast(np.ascontiguousarray(self.values.T))

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(row_id), _lists(solve(times_topics(batch, shared.value)))], [row_id, "v"])

        kind = dict(self.packed.dtypes)[row_id]
        return self.packed.select(row_id, "term_ids", "counts").mapInArrow(weigh, f"{row_id} {kind}, v array<double>")

    def table(self) -> DataFrame:
        rows = pa.table({"term_id": pa.array(np.arange(len(self.values))), "v": _lists(self.values)})
        return self.packed.sparkSession.createDataFrame(rows, SUMS)


#: Cells of documents that are put in one block (a document of more is in one block still), and that a task deals to blocks at a time.
CELLS_A_BLOCK, CELLS_AT_A_TIME = 1 << 20, 1 << 21
LAYOUT = ["block", "ids", "lengths", "codes", "counts", "terms"]


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers `starts[i]`, `starts[i]` + 1, ..., `lengths[i]` of them, for each i in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _pieces(rows: pa.Table) -> pa.RecordBatch:
    """What cells give to each of their blocks: ids and lengths of runs of one document, places in a list of terms, counts, and that list."""
    if "term" in rows.column_names:
        # Rows of one document that lie side by side.
        ids = rows.column(1).combine_chunks()
        first = np.concatenate([[0], np.flatnonzero(_changes(ids)) + 1])
        ids, block = ids.take(pa.array(first)), np.asarray(rows.column("block"))[first]
        lengths, terms, counts = np.diff(np.append(first, rows.num_rows)), rows.column("term"), rows.column("cnt")
    else:
        ids, block = rows.column(1).combine_chunks(), np.asarray(rows.column("block"))
        lengths = np.asarray(pc.list_value_length(rows.column("term_ids")))
        terms, counts = (pc.list_flatten(rows.column(name)) for name in ("term_ids", "counts"))
    coded = terms.combine_chunks().dictionary_encode()
    order = np.argsort(block, kind="stable")
    cell = _ranges((np.cumsum(lengths) - lengths)[order], lengths[order])
    runs = np.concatenate([[0], np.flatnonzero(np.diff(block[order])) + 1, [len(block)]])
    cells = np.concatenate([[0], np.cumsum(lengths[order])])[runs]
    code, own, places = np.asarray(coded.indices)[cell], [], []
    for start, end in zip(cells[:-1], cells[1:]):
        met, place = np.unique(code[start:end], return_inverse=True)
        own.append(met), places.append(place)

    def lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    arrays = [
        lists(runs, ids.take(pa.array(order))), lists(runs, pa.array(lengths[order], pa.int32())), lists(cells, pa.array(np.concatenate(places), pa.int32())),
        lists(cells, pa.array(np.asarray(counts)[cell], pa.float64())),
        lists(np.cumsum([0, *map(len, own)]), coded.dictionary.take(pa.array(np.concatenate(own)))),
    ]
    return pa.RecordBatch.from_arrays([pa.array(block[order][runs[:-1]], pa.int64()), *arrays], LAYOUT)


def _block(key: tuple[pa.Scalar, ...], pieces: pa.Table) -> pa.Table:
    """One block of its pieces; a document's runs are put side by side."""
    pieces = pieces.combine_chunks()
    ids, lengths, codes, counts, terms = (pc.list_flatten(pieces.column(name)).combine_chunks() for name in LAYOUT[1:])
    named, known = terms.dictionary_encode(), ids.dictionary_encode(null_encoding="encode")
    sizes = [np.asarray(pc.list_value_length(pieces.column(name))) for name in ("codes", "terms")]
    code = np.asarray(named.indices)[np.asarray(codes) + np.repeat(np.cumsum(sizes[1]) - sizes[1], sizes[0])]
    doc, lengths = np.asarray(known.indices), np.asarray(lengths, np.int64)
    order = np.argsort(doc, kind="stable")
    cell = _ranges((np.cumsum(lengths) - lengths)[order], lengths[order])
    total = np.zeros(len(known.dictionary), np.int64)
    np.add.at(total, doc, lengths)
    arrays = [known.dictionary, pa.array(total, pa.int32()), pa.array(code[cell], pa.int32()), counts.take(pa.array(cell)), named.dictionary]
    return pa.table([pa.array([key[0].as_py()], pa.int64()), *[_one(a) for a in arrays]], LAYOUT)


def blocked(packed: DataFrame) -> DataFrame:
    """Documents in blocks, stored once in buckets by block: ids, lengths, and cells as places in the block's own list of terms, and counts.

    `packed` is rows (row_id, term, cnt) with a table `named` of the terms' numbers, or documents (row_id, term_ids, counts). A document's block
    follows from its id, and there are as many as the cells (counted) ask for. Cells move once, in pieces that name each of their terms once.
    """
    if "blocks" in vars(packed):
        return packed.blocks
    row_id, kinds, spark = packed.columns[0], dict(packed.dtypes), packed.sparkSession
    n_cells = (packed.agg(F.count(F.lit(1))) if "term" in kinds else packed.agg(F.sum(F.size("term_ids")))).first()[0] or 0
    n_blocks, n_buckets = max(spark.sparkContext.defaultParallelism, -(-n_cells // CELLS_A_BLOCK)), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                cells += batch.num_rows if "term" in kinds else len(batch.column("term_ids").flatten())
            if cells >= CELLS_AT_A_TIME:
                yield _pieces(pa.Table.from_batches(held))
                held, cells = [], 0
        if held:
            yield _pieces(pa.Table.from_batches(held))

    terms = f"array<{kinds['term']}>" if "term" in kinds else kinds["term_ids"]
    schema = f"block bigint, ids array<{kinds[row_id]}>, lengths array<int>, codes array<int>, counts array<double>, terms {terms}"
    dealt = packed.select(F.pmod(F.xxhash64(row_id), F.lit(n_blocks)).alias("block"), *packed.columns).mapInArrow(deal, schema)
    blocks = dealt.repartition(n_buckets, "block").groupBy("block").applyInArrow(_block, schema)
    packed.blocks = bucketed(blocks, "block", "blocks", n_buckets, dealt=True)
    return packed.blocks


def _numbers(column: pa.ChunkedArray | pa.Array, kind: type = np.int64) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), kind) for value in column]


def _n_buckets(packed: DataFrame) -> int:
    return int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _n_parts(packed: DataFrame) -> int:
    """Parts of the terms, by the remainder of their numbers; fixed once for what was packed."""
    if "n_parts" not in vars(packed):
        packed.n_parts = PARTS_A_BUCKET * _n_buckets(packed)
    return packed.n_parts


def _cut(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(order of numbers by part and number, the parts that they have, start and end of each in that order)."""
    order = np.lexsort((ids, ids % n))
    part = ids[order] % n
    cuts = np.flatnonzero(np.append(np.full(min(len(part), 1), True), part[1:] != part[:-1]))
    return order, part[cuts], list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)]))


def wanted_terms(packed: DataFrame) -> DataFrame:
    """(part, of_block, at, ids): the terms that the blocks of documents look up, a row for a block and a part of the terms, stored once in buckets by part."""
    if "wanted" not in vars(packed):
        n = _n_parts(packed)
        own = blocked(packed).select(F.col("block").alias("of_block"), F.posexplode("terms").alias("at", "term_id"))
        if "named" in vars(packed):
            own = own.withColumnRenamed("term_id", "term").join(packed.named, "term").select("of_block", "at", "term_id")

        def deal(rows: pa.Table) -> pa.Table:
            at, ids = np.asarray(rows.column("at"), np.int32), np.asarray(rows.column("term_id"), np.int64)
            order, parts, cuts = _cut(ids, n)
            lists = [pa.array([a[order[start:end]].tobytes() for start, end in cuts], pa.binary()) for a in (at, ids)]
            return pa.table([pa.array(parts), pa.array(np.full(len(parts), rows.column("of_block")[0].as_py())), *lists], ["part", "of_block", "at", "ids"])

        packed.wanted = bucketed(own.groupBy("of_block").applyInArrow(deal, WANTED), "part", "wanted")
    return packed.wanted


def _dealt_values(packed: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(term_id, v) as a row for each part of the terms, in the buckets of what looks them up."""
    n = _n_parts(packed)

    def pack(values: pa.Table) -> pa.Table:
        ids = np.asarray(values.column("term_id"), np.int64)
        order = np.argsort(ids)
        v = _rows(values.column("v").combine_chunks(), width)[order]
        return pa.table([pa.array([int(ids[0]) % n]), pa.array([ids[order].tobytes()]), pa.array([v.tobytes()])], ["part", "ids", "v"])

    dealt = rows.select(F.pmod("term_id", F.lit(n)).cast("bigint").alias("part"), "term_id", "v").repartition(_n_buckets(packed), "part")
    return bucketed(dealt.groupBy("part").applyInArrow(pack, VALUES), "part", "term-values", dealt=True)


def block_weights(rows: DataFrame, k: int) -> DataFrame:
    """Weights of documents (block, place, v) as a row for each block."""

    def pack(rows: pa.Table) -> pa.Table:
        v = np.ascontiguousarray(_rows(rows.column("v").combine_chunks(), k))
        return pa.table([pa.array([rows.column("block")[0].as_py()]), pa.array([np.asarray(rows.column("place"), np.int32).tobytes()]), pa.array([v.tobytes()])], ["block", "at", "v"])

    return rows.select("block", "place", "v").groupBy("block").applyInArrow(pack, WEIGHTS)


def document_weights(weights: DataFrame, k: int) -> DataFrame:
    """What `block_weights` made one row of, as (block, place, v)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, at, v in (row for batch in batches for row in zip(batch.column("block"), _numbers(batch.column("at"), np.int32), _numbers(batch.column("v"), np.float64))):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block.as_py())), pa.array(at), _lists(v.reshape(-1, k))], ["block", "place", "v"])

    return weights.mapInArrow(unpack, "block bigint, place int, v array<double>")


def documents_of(bow: DataFrame, row_id: str, terms: DataFrame) -> DataFrame:
    """The cells of (row_id, term, cnt) for `blocked`, named once; `terms` (term_id, term) numbers their terms."""
    made = vars(bow).setdefault("documents", {})
    if row_id not in made:
        cells = bow.where(F.col("term").isNotNull()).select(row_id, "term", F.col("cnt").cast("double").alias("cnt"))
        cells.named = terms
        made[row_id] = cells
    return made[row_id]


@dataclass(frozen=True)
class Block:
    """A block of documents beside what was found of its terms: whether anything was, their numbers and values; and weights of documents that have some."""

    number: int
    ids: pa.Array
    doc: np.ndarray
    code: np.ndarray
    count: np.ndarray
    known: np.ndarray
    term_ids: np.ndarray
    values: np.ndarray
    weights: np.ndarray
    weighed: np.ndarray

    def times(self) -> np.ndarray:
        """X values for the documents X."""
        return np.stack([np.bincount(self.doc, self.count * v[self.code], len(self.ids)) for v in np.ascontiguousarray(self.values.T)], 1)

    def sums(self, w: np.ndarray) -> np.ndarray:
        """X'W, a row for each term of the block."""
        return np.stack([np.bincount(self.code, self.count * v[self.doc], len(self.values)) for v in np.ascontiguousarray(w.T)], 1)


class Kept:
    """A row of numbers for every term, as a stored table of a row for each part of the terms; tables of one kind have the same terms.

    Tables are in the same buckets by part as what looks terms up, so that they meet without a shuffle. They may be given as (term_id, v).
    """

    def __init__(self, packed: DataFrame, rows: DataFrame, width: int) -> None:
        self.packed, self.width = packed, width
        self.rows = self.holder = _dealt_values(packed, rows, width) if "term_id" in rows.columns else rows

    def done(self) -> None:
        """Free the space of these values, which nothing reads any more."""
        released(self.holder)

    def _beside(self, others: tuple[Kept, ...]) -> DataFrame:
        both = self.rows
        for i, other in enumerate(others):
            both = both.join(other.rows.withColumnsRenamed({"ids": f"ids{i}", "v": f"v{i}"}), "part")
        return both

    @staticmethod
    def _aligned(batch: pa.RecordBatch, widths: list[int]) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """(part, numbers of terms, their values in each table) of the terms that all tables have."""
        ids, values = ([_numbers(batch.column(2 * i + at), kind) for i in range(len(widths))] for at, kind in ((1, np.int64), (2, np.float64)))
        for row, part in enumerate(batch.column("part").to_pylist()):
            own, rows = [a[row] for a in ids], [a[row].reshape(-1, w) for a, w in zip(values, widths)]
            shared = own[0]
            for other in own[1:]:
                shared = shared if np.array_equal(shared, other) else np.intersect1d(shared, other)
            yield part, shared, [v if len(a) == len(shared) else v[np.searchsorted(a, shared)] for a, v in zip(own, rows)]

    def map(self, fn: Callable[..., np.ndarray], *others: Kept) -> Kept:
        widths, aligned = [self.width, *[o.width for o in others]], self._aligned
        width = fn(*[np.zeros((0, w)) for w in widths]).shape[1]

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, ids, values in (row for batch in batches for row in aligned(batch, widths)):
                out = np.ascontiguousarray(fn(*values), np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary())], ["part", "ids", "v"])

        # Each row keeps its part, so rows stay in the buckets that they come from.
        return Kept(self.packed, bucketed(self._beside(others).mapInArrow(each, VALUES), "part", "term-values", dealt=True), width)

    def sums(self, part: Callable[..., np.ndarray], *others: Kept) -> np.ndarray:
        return self._folded(part, others, np.add, F.sum)

    def most(self, part: Callable[..., np.ndarray], *others: Kept) -> np.ndarray:
        """The largest over terms of `part`(rows, ...), numbers that are the largest of any split of the terms."""
        return self._folded(part, others, np.maximum, F.max)

    def _folded(self, part: Callable[..., np.ndarray], others: tuple[Kept, ...], fold: np.ufunc, of_tasks: Callable[[str], Column]) -> np.ndarray:
        widths, aligned = [self.width, *[o.width for o in others]], self._aligned
        nothing = part(*[np.zeros((0, w)) for w in widths])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = nothing
            for _, _, values in (row for batch in batches for row in aligned(batch, widths)):
                total = fold(total, part(*values))
            flat = np.ravel(total)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["i", "total"])

        got = self._beside(others).mapInArrow(add, "i int, total double").groupBy("i").agg(of_tasks("total").alias("total")).collect()
        return np.array([r["total"] for r in sorted(got, key=lambda r: r["i"])]).reshape(nothing.shape)

    def by_block(self, work: Callable[[Block], pa.Table], schema: str, weights: DataFrame | None = None) -> DataFrame:
        """`work` for every block of documents; a block looks each of its terms up once. `weights`: of documents, a row a block (`block_weights`)."""
        width, blocks = self.width, blocked(self.packed).drop("terms")

        def find(wanted: pa.Table, held: pa.Table) -> pa.Table:
            known = np.concatenate([np.zeros(0, np.int64), *_numbers(held.column("ids"))])
            values = np.concatenate([np.zeros(0), *_numbers(held.column("v"), np.float64)]).reshape(-1, width)
            out = [[], [], []]
            for at, ids in zip(_numbers(wanted.column("at"), np.int32), _numbers(wanted.column("ids"))):
                place = np.searchsorted(known, ids)
                met = place < len(known)
                met[met] = known[place[met]] == ids[met]
                for column, a in zip(out, (at[met], ids[met], values[place[met]])):
                    column.append(a.tobytes())
            return pa.table([wanted.column("of_block"), *[pa.array(column, pa.binary()) for column in out]], ["of_block", "at", "ids", "v"])

        def each(block: pa.Table, found: pa.Table) -> pa.Table:
            row = block.to_batches()[0]
            lengths, code = np.asarray(row.column("lengths").flatten()), np.asarray(row.column("codes").flatten())
            n = int(code.max(initial=-1)) + 1
            known, term_ids, values = np.zeros(n, bool), np.zeros(n, np.int64), np.zeros((n, width))
            weighed, w = np.zeros(len(lengths), bool), np.zeros((len(lengths), width))
            for of_terms, at, ids, v in zip(found.column("ids").is_valid().to_pylist(), _numbers(found.column("at"), np.int32), found.column("ids"), _numbers(found.column("v"), np.float64)):
                if of_terms:
                    known[at], term_ids[at], values[at] = True, np.frombuffer(ids.as_buffer(), np.int64), v.reshape(-1, width)
                else:
                    weighed[at], w[at] = True, v.reshape(-1, width)
            doc, count = np.repeat(np.arange(len(lengths)), lengths), np.asarray(row.column("counts").flatten(), np.float64)
            return work(Block(row.column("block")[0].as_py(), row.column("ids").flatten(), doc, code, count, known, term_ids, values, w, weighed))

        found = wanted_terms(self.packed).groupBy("part").cogroup(self.rows.groupBy("part")).applyInArrow(find, FOUND)
        if weights is not None:
            found = found.unionAll(weights.select("block", "at", F.lit(None).cast("binary"), "v"))
        return blocks.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(each, schema)

    def _summed(self, work: Callable[[Block], tuple[np.ndarray, np.ndarray, np.ndarray | None]], width: int, size: int, weights: DataFrame | None = None, most: int = 0) -> tuple[Kept, np.ndarray, DataFrame]:
        """(sums by term, by measure, weights of documents) of what `work` makes of blocks; measures and weights travel as parts that do not exist.

        Of the last `most` measures the largest is taken instead of the sum.
        """
        n, nothing = _n_parts(self.packed), np.append(np.zeros(size - most), np.full(most, -np.inf))

        def each(block: Block) -> pa.Table:
            sums, measured, w = work(block)
            order, parts, cuts = _cut(block.term_ids[block.known], n)
            ids, sums = block.term_ids[block.known][order], sums[block.known][order]
            rows = [(part, ids[start:end], sums[start:end]) for part, (start, end) in zip(parts.tolist(), cuts)]
            rows.append((-1, np.zeros(0, np.int64), np.asarray(measured, np.float64)))
            if w is not None:
                rows.append((-2 - block.number, np.flatnonzero(block.weighed).astype(np.int32), w[block.weighed]))
            return pa.table([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (1, 2)]], ["part", "ids", "v"])

        def add(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = key[0].as_py()
            if part < -1:
                yield from rows
                return
            ids, total = np.zeros(0, np.int64), np.zeros((0, width)) if part >= 0 else nothing
            for batch in rows:
                values = _numbers(batch.column("v"), np.float64)
                if part < 0:
                    values = np.stack([total, *values])
                    total = np.append(values[:, : size - most].sum(0), values[:, size - most :].max(0))
                    continue
                all_ids = np.concatenate([ids, *_numbers(batch.column("ids"))])
                values = np.concatenate([total, *[v.reshape(-1, width) for v in values]])
                ids, place = np.unique(all_ids, return_inverse=True)
                total = np.stack([np.bincount(place, values[:, j], len(ids)) for j in range(width)], 1)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], ["part", "ids", "v"])

        parts = self.by_block(each, VALUES, weights).repartition(_n_buckets(self.packed), "part")
        sums = bucketed(parts.groupBy("part").applyInArrow(add, VALUES), "part", "term-values", dealt=True)
        measured = nothing
        for r in sums.where("part = -1").select("v").collect():
            measured = np.frombuffer(r["v"], np.float64)
        of_terms = Kept(self.packed, sums.where("part >= 0"), width)
        of_terms.holder = sums
        return of_terms, measured, sums.where("part < -1").select((-2 - F.col("part")).alias("block"), F.col("ids").alias("at"), "v")

    def product(self, solve: Solve, measure: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[Kept, np.ndarray]:
        width = solve(np.zeros((0, self.width))).shape[1]
        size = len(measure(np.zeros((0, self.width)), np.zeros((0, width))))

        def work(block: Block) -> tuple[np.ndarray, np.ndarray, None]:
            x = block.times()
            w = solve(x)
            return block.sums(w), measure(x, w), None

        return self._summed(work, width, size)[:2]

    def stepped(self, step: Callable[[np.ndarray, np.ndarray], np.ndarray], weights: DataFrame) -> tuple[Kept, np.ndarray, DataFrame]:
        """(X'W, W'W, weights) for new weights W = step(weights, X values) of the documents X; `weights` as `block_weights` makes them."""
        k = self.width

        def work(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            w = step(block.weights, block.times())
            return block.sums(w), (w.T @ w).ravel(), w

        sums, measured, weights = self._summed(work, k, k * k, weights)
        return sums, measured.reshape(k, k), weights

    def weights(self, solve: Solve, row_id: str, known_only: bool = False) -> DataFrame:
        """(row_id, v): the weights of every document, or of those with a term that has values."""

        def work(block: Block) -> pa.Table:
            w, ids = solve(block.times()), block.ids
            if known_only:
                met = np.bincount(block.doc, block.known[block.code], len(ids)) > 0
                w, ids = w[met], ids.filter(pa.array(met))
            return pa.table({row_id: ids, "v": _lists(w)})

        kind = dict(self.packed.dtypes)[row_id]
        return self.by_block(work, f"{row_id} {kind}, v array<double>")

    def table(self) -> DataFrame:
        """(term_id, v)."""
        width, aligned = self.width, self._aligned

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, ids, (values,) in (row for batch in batches for row in aligned(batch, [width])):
                yield pa.RecordBatch.from_arrays([pa.array(ids), _lists(values)], ["term_id", "v"])

        return self.rows.select("part", "ids", "v").mapInArrow(unpack, SUMS)


def numbered_terms(bow: DataFrame) -> DataFrame:
    """(term_id, term) of a bag of words, numbered from 0 in alphabetical order."""
    terms = with_sequential_id(bow.select("term").distinct(), ["term"], "term_id", start=0).select("term_id", "term")
    return stored(terms, "terms")


def pack_documents(bow: DataFrame, row_id: str, terms: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents as rows of numbered terms and counts, (term_id, term) numbered from 0 in alphabetical order)."""
    terms = terms if terms is not None else numbered_terms(bow)
    coded = lookup_join(bow, terms, ["term"], [row_id], "inner")
    entries = F.array_sort(F.collect_list(F.struct("term_id", F.col("cnt").cast("double").alias("cnt"))))
    packed = coded.groupBy(row_id).agg(entries.alias("e")).select(row_id, F.col("e.term_id").alias("term_ids"), F.col("e.cnt").alias("counts"))
    return stored(packed, "documents"), terms


def _gram(values: np.ndarray) -> np.ndarray:
    return values.T @ values


def _orthonormal(z: Held | Kept) -> Held | Kept:
    """Columns of the same span that are orthonormal, by two turns of Cholesky; dependent ones become 0."""
    for _ in range(2):
        values, vectors = np.linalg.eigh(z.sums(_gram))
        good = values > 1e-12 * max(values[-1], 1e-300)
        turn = np.where(good, vectors / np.sqrt(np.where(good, values, 1.0)), 0.0)
        before, z = z, z.map(lambda rows, t=turn: rows @ t)
        before.done()
    return z


def leading_vectors(first: Held | Kept, k: int) -> tuple[Held | Kept, np.ndarray]:
    """(k right singular vectors of the documents, singular values), from random values per term."""
    none = lambda x, w: np.zeros(1)
    same = lambda x: x
    basis = _orthonormal(first)
    for _ in range(POWER_ROUNDS):
        before, basis = basis, _orthonormal(basis.product(same, none)[0])
        before.done()
    pulled, _ = basis.product(same, none)
    small = basis.sums(lambda q, z: q.T @ z, pulled)
    pulled.done()
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:k]
    return basis.map(lambda q: q @ vectors[:, order]), np.sqrt(np.maximum(values[order], 0.0))


def nndsvd_topics(vectors: Held | Kept, sigma: np.ndarray) -> Held | Kept:
    """Topics to start from: of each pair of singular vectors the signs that hold more of it."""
    k = len(sigma)
    parts = lambda x: np.concatenate([np.maximum(x, 0) ** 2, np.minimum(x, 0) ** 2], 1).sum(0)
    _, of_documents = vectors.product(lambda x: x, lambda x, w: parts(x))
    of_terms = vectors.sums(parts)
    held = np.sqrt(of_documents * of_terms)
    # The first pair is of one sign up to rounding.
    sign = np.where(held[:k] >= held[k:], 1.0, -1.0)
    norm = np.sqrt(np.where(sign > 0, of_terms[:k], of_terms[k:]))
    scale = np.sqrt(np.maximum(held[:k], held[k:])) / np.where(norm > 0, norm, 1.0)
    first = np.arange(k) == 0
    return vectors.map(lambda v: np.where(first, np.abs(v), np.maximum(v * sign, 0)) * scale)


def factor_nmf(
    bow: DataFrame, row_id: str, k: int = 5, max_rounds: int = 200, seed: int = 42, tol: float = 1e-4, held_terms: int = BROADCAST_ROWS
) -> FittedNmf:
    """Factor (row_id, term, cnt) into weights of k topics, until the projected gradient is under `tol` times the first.

    `losses` are the squared errors before each round and at the end; none is larger than the one before. `topics` and `docs` of
    the result hold the optimum for each other's last value. More topics than documents or terms are 0.
    """
    known = vars(bow).get("documents", {}).get(row_id)
    terms = numbered_terms(bow) if known is None else known.named
    n_terms = terms.count()
    if n_terms <= held_terms:
        packed, terms = pack_documents(bow, row_id, terms)
        n_docs = packed.count()
    else:
        # Cells go to blocks as they are, which further fits of the same bag share.
        packed = documents_of(bow, row_id, terms)
        n_docs = blocked(packed).agg(F.sum(F.size("ids"))).first()[0]
    if not n_docs:
        raise ValueError("no document has a term")
    squares = float(bow.where(F.col("term").isNotNull()).agg(F.sum(F.col("cnt").cast("double") * F.col("cnt"))).first()[0])
    q = min(k + OVERSAMPLE, n_docs, n_terms)
    if n_terms <= held_terms:
        topics = Held(packed, np.random.default_rng(seed).normal(size=(n_terms, q)))
    else:
        normal = [F.sqrt(-2 * F.log(unit(seed, 2 * j))) * F.cos(2 * np.pi * unit(seed, 2 * j + 1)) for j in range(q)]
        topics = Kept(packed, terms.select("term_id", F.array(*normal).alias("v")), q)
    vectors, sigma = leading_vectors(topics, min(k, q))
    h = nndsvd_topics(vectors, sigma)
    vectors.done()
    if k > q:
        h = h.map(lambda v: np.concatenate([v, np.zeros((len(v), k - q))], 1))
    losses, gradients = [], []
    for _ in range(max_rounds + 1):
        gram = h.sums(_gram)
        solve = lambda x, g=gram: least_squares(g, x)
        measure = lambda x, w: np.append(_gram(w).ravel(), (x * w).sum())
        sums, measured = h.product(solve, measure)
        of_weights = measured[:-1].reshape(k, k)
        losses.append(float(squares - 2 * measured[-1] + (of_weights * gram).sum()))

        def steep(v: np.ndarray, s: np.ndarray, g: np.ndarray = of_weights) -> np.ndarray:
            slope = v @ g - s
            return np.array([(np.where(v > 0, slope, np.minimum(slope, 0)) ** 2).sum()])

        gradients.append(float(h.sums(steep, sums)[0]) ** 0.5)
        still = len(losses) > 1 and losses[-2] - losses[-1] <= STILL * squares
        if gradients[-1] <= tol * gradients[0] or still or len(losses) > max_rounds:
            break
        before, h = h, h.map(lambda v, s, g=of_weights: least_squares(g, s, v), sums)
        before.done(), sums.done()
    named = terms.join(h.table(), "term_id").select("term", *[F.get("v", F.lit(j)).alias(f"h{j}") for j in range(k)])
    docs = h.weights(solve, row_id).select(row_id, *[F.get("v", F.lit(j)).alias(f"w{j}") for j in range(k)])
    return FittedNmf(stored(named, "topics"), stored(docs, "weights"), k, row_id, tuple(losses), tuple(gradients))


def unit(seed: int, j: int):
    """A number in (0, 1) fixed by the term's number, a place and a seed."""
    return (F.pmod(F.xxhash64("term_id", F.lit(j), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def document_topics(model: NmfModel) -> DataFrame:
    """(row_id, topic, loading) of the documents a model was fitted to."""
    return loadings(model.docs, model.row_id, model.k)


def optimality(bow: DataFrame, model: NmfModel) -> DataFrame:
    """One row that holds a fit against its bag of words by joins and sums alone, in one pass over its blocks.

    `loss` is the squared error; `steepest_topics` and `steepest_weights` are the largest projected gradients, relative to the largest
    sum that they are the difference of; `least` is the smallest number of both factors.
    """
    k, row_id = model.k, model.row_id
    w, h = [f"w{j}" for j in range(k)], [f"h{j}" for j in range(k)]

    def gram(table: DataFrame, names: list[str]) -> np.ndarray:
        # One row of a few numbers.
        sums = table.agg(*[F.sum(F.col(a) * F.col(b)) for a in names for b in names]).first()
        return np.array([float(v or 0.0) for v in sums]).reshape(k, k)

    def steep(values: np.ndarray, products: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The largest projected gradient, the largest sum that it is a difference of, and the least value (with its sign turned)."""
        slope = values @ products - sums
        ups = np.abs(np.where(values > 0, slope, np.minimum(slope, 0)))
        return np.array([a.max(initial=-np.inf) for a in (ups, sums, -values)])

    of_h, of_w = gram(model.topics, h), gram(model.docs, w)
    known = vars(bow).get("documents", {}).get(row_id)
    packed = documents_of(bow, row_id, numbered_terms(bow)) if known is None else known
    topics = Kept(packed, packed.named.join(model.topics, "term").select("term_id", F.array(*h).alias("v")), k)
    places = blocked(packed).select("block", F.posexplode("ids").alias("place", row_id))
    weights = block_weights(places.join(model.docs, row_id).select("block", "place", F.array(*w).alias("v")), k)

    def work(block: Block) -> tuple[np.ndarray, np.ndarray, None]:
        # Cells count whose term and document both have weights.
        met = block.known[block.code] & block.weighed[block.doc]
        own = replace(block, doc=block.doc[met], code=block.code[met], count=block.count[met])
        sums = own.times()
        used = np.bincount(own.doc, minlength=len(block.ids)) > 0
        mine, sums = block.weights[used], sums[used]
        # The last column counts the cells of a term, as one without any is not told of.
        cells = np.bincount(own.code, minlength=len(block.values))[:, None]
        by_term = np.concatenate([own.sums(block.weights), cells.astype(np.float64)], 1)
        return by_term, np.concatenate([[np.square(own.count).sum(), (mine * sums).sum()], steep(mine, of_h, sums)]), None

    of_terms, (squares, cross, *of_weights), _ = topics._summed(work, k + 1, 5, weights, most=3)
    of_topics = topics.most(lambda values, sums: steep(values[sums[:, k] > 0], of_w, sums[sums[:, k] > 0, :k]), of_terms)
    loss = squares - 2 * cross + (of_h * of_w).sum()
    row = (squares, loss, of_topics[0] / of_topics[1], of_weights[0] / of_weights[1], min(-of_topics[2], -of_weights[2]))
    return bow.sparkSession.createDataFrame([tuple(map(float, row))], "squares double, loss double, steepest_topics double, steepest_weights double, least double")
