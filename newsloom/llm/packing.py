"""Mixture-controlled packing (operator 10).

Every source is a queue of token ids. Deficit round-robin serves the queues window by window: a queue
earns its share of each window, takes whole ids, and carries what is left of an id to the next window.
The account after T ids is closed: queues 1..k together have been served floor(T * ids in them / all ids).
So every task finds the windows of its documents by itself, deficits cross windows and partitions
(no queue is ever more than one id off its share), and each id lies in one place.

All windows are full; what remains after the last is cut into sequences of powers of two, so nothing is
padded. A source that earns less than one id a window shares a queue with others of that kind, which
are served one after the other (and joins the first queue if together they still earn less); so there are at
most as many queues as ids in a window. Documents are queued in order of task and place.

Cases: a text of any length is cut into as many windows as it needs, none left out; equal documents are queued in order of task and place; a null or empty text is its end id alone; a null source is a source of its own; repeated rows
are packed as often as they occur; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import key_of
from newsloom.llm.registry import query, table
from newsloom.llm.tokens import id_type, slices, tokenized
from newsloom.operators.joins import lookup_join
from newsloom.session import stored

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def share_floor(windows: np.ndarray, earned: np.ndarray, total: int) -> np.ndarray:
    """floor(windows * earned / total) without overflow, by long division in digits of 16 bits; total < 2^46."""
    windows, earned = np.broadcast_arrays(windows.astype(np.int64), earned.astype(np.int64))
    quotient, rest = np.zeros_like(windows), np.zeros_like(windows)
    whole, part = np.divmod(earned, total)
    for shift in (32, 16, 0):
        rest = (rest << 16) + ((windows >> shift) & 0xFFFF) * part
        quotient = (quotient << 16) + rest // total
        rest %= total
    return quotient + windows * whole


class Plan:
    """Where each id of each queue lies, from the queues' sizes alone."""

    def __init__(self, sizes: list[int], window: int = WINDOW) -> None:
        self.window, self.total = window, sum(sizes)
        self.upto = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.full = self.total // window
        self.rest = self.total - self.full * window
        self.tail = [1 << b for b in range(self.rest.bit_length() - 1, -1, -1) if self.rest >> b & 1]
        self.tail_ends = np.cumsum(self.tail)

    def served(self, queues: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Ids that queues before `queues` have given to the first `windows` windows."""
        return share_floor(windows, self.upto[queues] * self.window, self.total)

    def own(self, queue: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Ids of `queue` in the first `windows` windows."""
        return self.served(queue + 1, windows) - self.served(queue, windows)

    def window_of(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The window that holds id number `at` of `queue`; `full` for those behind all windows."""
        size = np.maximum(1, self.upto[queue + 1] - self.upto[queue])
        w = np.minimum(self.full, (at / size * (self.total / self.window)).astype(np.int64))
        # The estimate is off by a few windows where a queue earns little; step until it fits.
        while True:
            late = (w > 0) & (self.own(queue, w) > at)
            early = ~late & (w < self.full) & (self.own(queue, np.minimum(w + 1, self.full)) <= at)
            if not (late.any() or early.any()):
                return w
            w = w - late + early

    def pieces(self, queue: np.ndarray, start: np.ndarray, length: np.ndarray):
        """(row, start in row, length, sequence, offset) of rows that lie at [start, start + length) of their queues."""
        first, last = self.window_of(queue, start), self.window_of(queue, start + length - 1)
        row = np.repeat(np.arange(len(queue)), last - first + 1)
        w = np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1) + first[row]
        q = queue[row]
        begins = self.own(q, w)
        inside = w < self.full
        ends = np.where(inside, self.own(q, np.minimum(w + 1, self.full)), self.upto[q + 1] - self.upto[q])
        a = np.maximum(start[row], begins)
        b = np.minimum((start + length)[row], ends)
        lead = np.where(inside, self.served(q, np.minimum(w + 1, self.full)) - self.served(q, w), self.upto[q] - self.served(q, w))
        offset = lead + a - begins
        out = [row[inside], (a - start[row])[inside], (b - a)[inside], w[inside], offset[inside]]
        if not inside.all():
            out = [np.concatenate([x, y]) for x, y in zip(out, self._tail_pieces(row[~inside], (a - start[row])[~inside], (b - a)[~inside], offset[~inside]))]
        keep = out[2] > 0
        return [x[keep] for x in out]

    def _tail_pieces(self, row, at, length, offset):
        found = []
        for r, s, n, o in zip(row.tolist(), at.tolist(), length.tolist(), offset.tolist()):
            while n > 0:
                k = int(np.searchsorted(self.tail_ends, o, side="right"))
                take = min(n, int(self.tail_ends[k]) - o)
                found.append((r, s, take, self.full + k, o - (int(self.tail_ends[k]) - self.tail[k])))
                s, n, o = s + take, n - take, o + take
        return np.array(found, np.int64).reshape(-1, 5).T


def queue_starts(tokens: DataFrame, window: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """(part, source_key, queue, before): ids queued before a task's rows of a source; sizes of the queues."""
    sums = stored(tokens.groupBy("part", "source_key").agg(F.sum("n_tokens").alias("n")), "pack-sums")
    per_source = sums.groupBy("source_key").agg(F.sum("n").alias("n"))
    total = per_source.agg(F.sum("n").alias("n")).first()["n"] or 0
    # Sources with a queue of their own; there are at most `window`.
    big = [(r["source_key"], r["n"]) for r in per_source.where(F.col("n") * window >= total).orderBy("source_key").collect()]
    small = total - sum(n for _, n in big)
    joined = bool(small) and small * window < total
    sizes = [n for _, n in big] + ([small] if small and not joined else [])
    if joined:
        sizes[0] += small
    number = F.create_map(*[x for i, (k, _) in enumerate(big) for x in (F.lit(k), F.lit(i))])[F.col("source_key")] if big else F.lit(None).cast("int")
    rest = 0 if joined else len(big)
    # Within a queue by source, then by task. Rows here are one per task and source.
    order = Window.partitionBy("queue").orderBy("late", "source_key", "part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = sums.withColumn("late", number.isNull()).withColumn("queue", F.coalesce(number, F.lit(rest)))
    starts = numbered.select("part", "source_key", "queue", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return stored(starts, "pack-starts"), sizes


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents (doc_id, source, text) with `ids`, their place and their source's queue."""
    dtype = id_type(tokenizer_path)
    keyed = docs.select("doc_id", key_of(F.col("source")).alias("source_key"), "text")
    tokens = stored(tokenized(keyed, tokenizer_path, end_id, by="source_key"), "pack-ids")
    starts, sizes = queue_starts(tokens, window)
    placed = lookup_join(tokens, starts, ["part", "source_key"], ["doc_id", "start_in_part"], "inner")
    plan = Plan(sizes, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big):
                number = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
                queue, start, length = number("queue"), number("at"), number("n_tokens")
                row, s, n, sequence, offset = plan.pieces(queue, start, length)
                values = batch.column("ids")
                raw = [values[i].as_py() for i in range(batch.num_rows)]
                wide = [np.frombuffer(r, dtype).astype("<u4").tobytes() for r in raw]
                crc = [zlib.crc32(wide[r][4 * a : 4 * (a + m)]) for r, a, m in zip(row.tolist(), s.tolist(), n.tolist())]
                ids = [wide[r][4 * a : 4 * (a + m)] for r, a, m in zip(row.tolist(), s.tolist(), n.tolist())]
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(taken), pa.array(s), pa.array(n), pa.array(crc, pa.int64()), pa.array(length[row]), pa.array(sequence), pa.array(offset), pa.array(queue[row], pa.int32()), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue", "ids"],
                )

    ready = placed.select("doc_id", "queue", (F.col("before") + F.col("start_in_part")).alias("at"), "n_tokens", "ids")
    return ready.mapInArrow(cut, PIECES + ", queue int, ids binary")


@query("op10_pack_sequences")
def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
