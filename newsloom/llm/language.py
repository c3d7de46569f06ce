"""Language identification by prediction by partial matching (operator 2).

Each language has a tree of byte contexts of up to three bytes. After a context that training has seen n
times, followed by d distinct bytes, a byte seen c times there has probability c / (n + d); the
others share the escape probability d / (n + d) and are looked up after the context without its
first byte, down to a uniform choice of 256 bytes. The statistics are frozen after training,
so the exact code length of a byte depends on it and the three bytes before alone, and is
computed once per (longest known context, byte) for all languages, and kept in half precision. A text's code length under a
language is the sum over its bytes; the shortest wins, and the score is its posterior probability
among the languages at equal priors, where bits count for at most `TRUSTED_BYTES` bytes.

Training reads at most `MAX_ROWS` labelled rows per language, chosen by a hash of the id, and sums counts by
(language, four bytes). Bytes training never saw have all the same code length, so they share a code. Upper
case ASCII letters are read as lower case.

Cases: a text of any length is read whole, by a task that holds the bytes of one batch; null, blank or letterless text is `und` with score 0; ties between languages go to the first by
name; rows with null language are not learned from; without any labelled row everything is `und`; repeated
rows are predicted alike; an empty table gives no rows; extra columns stay, those of the outputs' names
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import fold, unused
from newsloom.llm.registry import query, table

MAX_ROWS = 3000
ORDER = 3
TRUSTED_BYTES = 400
CHUNK = 1 << 19
UND = "und"
START = 32


def byte_chunks(column: pa.ChunkedArray | pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows with about `size` bytes; nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, it and the three bytes before in its text (blanks before its start), as one number."""
    out = data.astype(np.uint32)
    begins = np.repeat(offsets[:-1], np.diff(offsets))
    place = np.arange(len(data)) - begins
    for back in range(1, ORDER + 1):
        earlier = np.full(len(data), START, np.uint32)
        earlier[back:] = data[: len(data) - back] if back else data
        earlier[place < back] = START
        out |= earlier << np.uint32(8 * back)
    return out


def count_grams(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, gram, n) over all rows of `docs`; a task adds up before it sends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(lang).to_pylist(), object)
            for name in sorted(set(langs.tolist())):
                own = batch.column(text).filter(pa.array(langs == name))
                parts = [np.unique(grams(FOLD[data], offsets), return_counts=True) for _, _, data, offsets in byte_chunks(own)]
                keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                sums = np.bincount(place, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(sums)], ["lang", "gram", "n"])

    counted = docs.select(lang, text).mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Code lengths of bytes after contexts, for all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(counts)
        seen = np.zeros(256, bool)
        seen[START] = True
        for keys, _ in counts.values():
            seen[np.unique(keys & 0xFF)] = True
        known = np.flatnonzero(seen)
        # Code 0 stands for all bytes that training never saw.
        self.code = np.zeros(256, np.int32)
        self.code[known] = np.arange(1, len(known) + 1)
        self.width = a = len(known) + 1
        self.sharing = 256 - len(known)
        coded = {
            name: ([self.code[(keys >> (8 * b)) & 0xFF].astype(np.int64) for b in range(ORDER + 1)], n.astype(np.float64))
            for name, (keys, n) in counts.items()
        }
        # A context of three codes maps to a row: its own if any language knows it, else that of its last two.
        two = np.arange(a * a, dtype=np.int32)
        contexts = np.unique(np.concatenate([(k[3] * a + k[2]) * a + k[1] for k, _ in coded.values()])) if coded else np.zeros(0, np.int64)
        self.row = np.tile(two, a)
        self.row[contexts] = a * a + np.arange(len(contexts), dtype=np.int32)
        self.bits = np.zeros((len(self.languages), (a * a + len(contexts)) * a), np.float16)
        for at, name in enumerate(self.languages):
            k, n = coded[name]
            level = np.full((1, a), 1.0 / 256)
            for order in range(ORDER):
                size = a**order
                context = np.zeros(len(n), np.int64)
                for b in range(order, 0, -1):
                    context = context * a + k[b]
                level = self._blend(np.bincount(context * a + k[0], n, size * a).reshape(size, a), np.tile(level, (size // len(level), 1)))
            where = np.searchsorted(contexts, (k[3] * a + k[2]) * a + k[1])
            own = self._blend(np.bincount(where * a + k[0], n, len(contexts) * a).reshape(len(contexts), a), level[contexts % (a * a)])
            self.bits[at] = -np.log2(np.concatenate([level, own])).ravel()

    def _blend(self, counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """Probabilities after contexts with these counts; what was not seen there escapes to `shorter`."""
        n, d = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        unseen = np.where(counts > 0, 0.0, shorter)
        # An unseen byte gets its share of the escape by its weight among all that were not seen here.
        left = np.maximum(unseen.sum(1, keepdims=True) + (self.sharing - 1) * unseen[:, :1], 1e-12)
        with np.errstate(invalid="ignore", divide="ignore"):
            mixed = np.where(counts > 0, counts / (n + d), unseen / left * d / (n + d))
        return np.where(n > 0, mixed, shorter)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language (texts x languages)."""
        a, codes = self.width, self.code[FOLD[data]]
        place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
        before = []
        for back in range(1, ORDER + 1):
            earlier = np.full(len(codes), self.code[START], np.int32)
            earlier[back:] = codes[: len(codes) - back]
            earlier[place < back] = self.code[START]
            before.append(earlier)
        cell = self.row[(before[2] * a + before[1]) * a + before[0]].astype(np.int64) * a + codes
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            for at in range(len(self.languages)):
                out[filled, at] = np.add.reduceat(self.bits[at][cell], offsets[filled], dtype=np.float64)
        return out


def train(docs: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Learn from `docs` (doc_id, text, lang), whose labels are trusted."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count().collect()
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, max_rows / r["count"]))).otherwise(share)
    picked = known.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    counts: dict[str, tuple[list, list]] = {r["lang"]: ([], []) for r in sizes}
    for r in count_grams(picked.select("lang", "text")).toLocalIterator():
        counts[r["lang"]][0].append(r["gram"])
        counts[r["lang"]][1].append(r["n"])
    return Model({k: (np.array(g, np.int64), np.array(n, np.int64)) for k, (g, n) in counts.items() if g})


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit("\\p{L}")), F.lit(False))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` and `bits_per_byte` under the predicted language."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    outputs = [f.name for f in added]
    others = [f for f in docs.schema.fields if f.name not in outputs]
    schema = T.StructType([*others, *added])
    shared, readable_ = docs.sparkSession.sparkContext.broadcast(model), unused(docs, "readable")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            best = np.full(batch.num_rows, -1)
            score, per_byte = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            readable = np.array(batch.column(readable_))
            for at, rows, data, offsets in byte_chunks(batch.column(text)) if own.languages else ():
                bits = own.code_lengths(data, offsets)
                here, n = slice(at, at + rows), np.diff(offsets)
                best[here] = bits.argmin(1)
                weight = np.minimum(1.0, TRUSTED_BYTES / np.maximum(1, n))[:, None]
                over = (bits - bits.min(1, keepdims=True)) * weight
                score[here] = 1 / np.exp2(-over).sum(1)
                per_byte[here] = bits.min(1) / np.maximum(1, n)
            names = [own.languages[b] if b >= 0 and r else UND for b, r in zip(best.tolist(), readable.tolist())]
            unknown = np.array([n == UND for n in names], bool)
            score[unknown] = 0.0
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in others], pa.array(names), pa.array(score), pa.array(per_byte)], [*[f.name for f in others], *outputs]
            )

    return docs.select(*[f.name for f in others], has_letter(F.col(text)).alias(readable_)).mapInArrow(label, schema)


def identify(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text, lang, ...) with predictions, learned from the rows outside the held-out fold."""
    return predict(docs, train(docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang")))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", 4) != 2).select("doc_id", "text", "lang"))
    told = predict(docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
