"""TF-IDF in long form: one row per document and term."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import counted, ngrams, words
from newsloom.operators.conform import drop_blank
from newsloom.operators.joins import is_small
from newsloom.operators.ranking import top_n, top_n_per_group, with_sequential_id
from newsloom.session import stored

PAIRS_A_PART = 1000
#: Words that are counted at a time, and of which one chunk of texts is made (a longer text is its own).
WORDS_AT_A_TIME, WORDS_A_CHUNK = 1 << 20, 1 << 20
#: Keys of a run and a document that fit in one number.
MOST_KEYS = 1 << 62
#: Bits of a chunk's number that count the chunks of a partition.
CHUNK_BITS = 20
#: Cells that leave a chunk at a time.
CELLS_OUT = 1 << 18
#: The least parts of a vocabulary that chunks look up; the most terms of a part, and the most chunks for each part, as powers of two.
LEAST_PARTS, PART_BITS, CHUNKS_A_PART_BITS = 64, 17, 3


@dataclass(frozen=True)
class TfidfConfig:
    """Counts are absolute when int and shares of all documents when float."""

    ngram_range: tuple[int, int] = (1, 2)
    min_df: int | float = 3
    max_df: int | float = 0.90
    max_features: int | None = None
    norm: str | None = "l2"
    use_idf: bool = True
    smooth_idf: bool = True
    sublinear_tf: bool = False
    dtype: str = "float32"


class Sieve:
    """A sketch of the terms of at least `least` documents: it may let others through, but never holds one of these back.

    Terms are known by 40 bits of their hash. Tasks send the hashes of the different terms of what they hold and their documents
    there, up to `least`; a part of the hashes adds these up and marks those that reach `least` on two rows of
    places, 2^`bits` bits each in all parts. So terms that do not reach it mark nothing, however many there are.
    """

    def __init__(self, least: int, bits: int) -> None:
        self.least, self.bits, self.passes = least, bits, np.zeros((2, 0), np.uint8)

    @property
    def part_bits(self) -> int:
        """Bits of a hash that tell its part."""
        return min(SIEVE_PART_BITS, self.bits - 3)

    def _within(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two places of hashes among those of their part; `rest` are their 32 bits after the part's."""
        left = np.uint64(self.bits - self.part_bits)
        return rest & np.uint64((1 << int(left)) - 1), rest >> (np.uint64(32) - left)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part, rest = self._split(hashes)
        start = part << np.uint64(self.bits - self.part_bits)
        one, two = self._within(rest)
        return start | one, start | two

    def _split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unsigned = hashes.astype(np.int64, copy=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        unsigned = (unsigned ^ (unsigned >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        kept = np.uint64(self.part_bits)
        return unsigned >> (np.uint64(64) - kept), (unsigned >> (np.uint64(32) - kept)) & np.uint64(0xFFFFFFFF)

    def fill(self, terms: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]] | None = None) -> Sieve:
        """Count `terms` (hashes: the different terms of a document as 64-bit numbers), or what `hashes_of` makes of a batch."""
        least, n_parts, split, within = self.least, 1 << self.part_bits, self._split, self._within
        size = 1 << (self.bits - self.part_bits)

        hashes_of = hashes_of or (lambda batch: iter([np.asarray(batch.column("hashes").flatten())]))

        kind = np.uint8 if least < 256 else np.int64

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0

            def out() -> pa.RecordBatch:
                keys = np.concatenate(held)
                held.clear()
                keys.sort()
                at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                counts, keys = np.minimum(np.diff(np.append(at, len(keys))), least).astype(kind), keys[at]
                ends = np.searchsorted(keys, np.arange(n_parts + 1, dtype=np.uint64) << np.uint64(32))
                met = np.flatnonzero(np.diff(ends))
                packed = [[a[ends[part] : ends[part + 1]].tobytes() for part in met.tolist()] for a in (keys.astype("<u4"), counts)]
                return pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *[pa.array(p, pa.binary()) for p in packed]], ["part", "hashes", "counts"])

            for hashes in (hashes for batch in batches for hashes in hashes_of(batch) if len(hashes)):
                part, rest = split(hashes)
                held.append((part << np.uint64(32)) | rest)
                n += len(hashes)
                if n >= HASHES_AT_A_TIME:
                    yield out()
                    n = 0
            if n:
                yield out()

        def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
            at = np.flatnonzero(np.append(np.full(min(len(key), 1), True), key[1:] != key[:-1]))
            return key[at], np.minimum(np.add.reduceat(count, at), least).astype(kind) if len(at) else count.astype(kind)

        def merge(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, counts, n = [np.zeros(0, "<u4")], [np.zeros(0, kind)], 0
            for batch in groups:
                for some, numbers in zip(batch.column("hashes"), batch.column("counts")):
                    keys.append(np.frombuffer(some.as_buffer(), "<u4")), counts.append(np.frombuffer(numbers.as_buffer(), kind))
                    n += len(keys[-1])
                    if n >= HASHES_AT_A_TIME:
                        keys, counts = ([a] for a in added(keys, counts))
                        n = 0
            all_keys, totals = added(keys, counts)
            frequent = all_keys[totals >= least].astype(np.uint64)
            marks = np.zeros((2, size), bool)
            for row, at in enumerate(within(frequent)):
                marks[row, at] = True
            rows = [np.packbits(row, bitorder="little").tobytes() for row in marks]
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *[pa.array([r], pa.binary()) for r in rows]], ["part", "one", "two"])

        marked = terms.mapInArrow(send, "part int, hashes binary, counts binary").groupBy("part").applyInArrow(merge, "part int, one binary, two binary")
        self.passes = np.zeros((2, (1 << self.bits) // 8), np.uint8)
        for r in marked.collect():
            for row, name in enumerate(("one", "two")):
                self.passes[row, r["part"] * (size // 8) : (r["part"] + 1) * (size // 8)] = np.frombuffer(r[name], np.uint8)
        return self

    def lets_through(self, hashes: np.ndarray) -> np.ndarray:
        one, two = [(self.passes[row][at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 for row, at in enumerate(self.places(hashes))]
        return (one & two).astype(bool)

    def mask(self, spark: SparkSession, hashes: Column) -> Column:
        """For arrays of hashes, which of them may be frequent."""
        shared = spark.sparkContext.broadcast(self)

        @F.arrow_udf("array<boolean>")
        def told(column: pa.Array) -> pa.Array:
            flat = pc.fill_null(column.flatten(), 0)
            ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0)))])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(shared.value.lets_through(np.asarray(flat))))

        return told(hashes)


#: Places in a row of the sieve, as powers of two: the least and the most, for as many as there are words between; and its parts.
SIEVE_BITS, MOST_SIEVE_BITS, SIEVE_PART_BITS = 23, 28, 8
#: Hashes of terms that a task holds before it adds them up.
HASHES_AT_A_TIME = 1 << 22


@dataclass(frozen=True)
class TfidfModel:
    """`vocabulary` has one row per term: term_id, term, df, cf, idf. `sieve` holds back most other terms."""

    vocabulary: DataFrame
    n_docs: int
    config: TfidfConfig
    row_id: str
    col: str
    sieve: Sieve | None = None


@dataclass(frozen=True)
class Cells:
    """The counts of some texts: text `doc[i]` has `count[i]` times the term `terms[term[i]]`; by text, each term once."""

    terms: pa.Array
    hashes: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    count: np.ndarray


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return np.asarray(coded.indices, np.int64), coded.dictionary


@dataclass(frozen=True)
class Runs:
    """The n-grams of one length in some texts: text `doc[i]` has `count[i]` times the run `term[i]`; by run.

    A different run is a word (`last`) after one of the runs that are a word shorter (`first` of `before`).
    """

    hashes: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    count: np.ndarray
    first: np.ndarray
    last: np.ndarray
    before: Runs | None

    def spelled(self, words: pa.Array, which: np.ndarray) -> pa.Array:
        own = words.take(pa.array(self.last[which]))
        return own if self.before is None else pc.binary_join_element_wise(self.before.spelled(words, self.first[which]), own, " ")


def _runs(words: pa.Array, word: np.ndarray, lengths: np.ndarray, low: int, high: int) -> Iterator[Runs]:
    """The runs of `low`..`high` words in texts of `lengths` words each, `word` by number in `words`."""
    # Places, numbers and counts within a slice of texts are under 2^31; only keys are longer.
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    n_docs, n_words = max(len(lengths), 1), max(len(words), 1)
    own = pd.util.hash_array(np.asarray(words.to_numpy(zero_copy_only=False), object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    key, starts, before = word, np.arange(len(word), dtype=np.int32), None
    for n in range(1, high + 1):
        if n > 1:
            inside = starts + n - 1 < len(word)
            inside[inside] = doc[starts[inside]] == doc[starts[inside] + n - 1]
            starts = starts[inside]
            key = key[inside] * n_words + word[starts + n - 1]
        most = int(key.max(initial=0)) + 1
        names = None
        if 1 < n < high or most * n_docs >= MOST_KEYS:
            # Runs that go on, or too many to tell beside a document, are numbered first, as words are.
            key, names = _coded(pa.array(key))
            names = np.asarray(names, np.int64)
        cells = key * n_docs
        cells += doc[starts]
        cells.sort()
        n_cells, new = len(cells), np.append(np.full(min(len(cells), 1), True), cells[1:] != cells[:-1])
        at = np.flatnonzero(new).astype(np.int32)
        gram, of = np.divmod(cells[at], n_docs)
        del cells, new
        other = np.append(np.full(min(len(gram), 1), True), gram[1:] != gram[:-1])
        different = gram[other]
        if names is not None:
            # Each number was met, so these are all of them in order.
            different = names
        first, last = np.divmod(different, n_words)
        if before is None:
            hashes = own[last]
        else:
            hashes = (before.hashes[first] ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) + own[last]
            hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            hashes ^= hashes >> np.uint64(32)
        term, count = np.cumsum(other, dtype=np.int32) - np.int32(1), np.diff(np.append(at, np.int32(n_cells)))
        before = Runs(hashes, of.astype(np.int32), term, count, first.astype(np.int32), last.astype(np.int32), before)
        if n >= low:
            yield before


def _cells(words: pa.Array, word: np.ndarray, lengths: np.ndarray, config: TfidfConfig, sieve: Sieve | None = None) -> Cells:
    """The n-grams of texts of numbered words; only those that the sieve lets through are written out."""
    terms, hashes, docs, grams, counts, n_terms = [], [], [], [], [], 0
    for runs in _runs(words, word, lengths, *config.ngram_range):
        kept = sieve.lets_through(runs.hashes) if sieve else np.full(len(runs.hashes), True)
        number, mine = np.cumsum(kept, dtype=np.int32) + np.int32(n_terms - 1), kept[runs.term]
        terms.append(runs.spelled(words, np.flatnonzero(kept)).cast(pa.string())), hashes.append(runs.hashes[kept])
        docs.append(runs.doc[mine]), grams.append(number[runs.term[mine]]), counts.append(runs.count[mine])
        n_terms += int(kept.sum())
    return Cells(pa.concat_arrays(terms), np.concatenate(hashes), np.concatenate(docs), np.concatenate(grams), np.concatenate(counts))


def _numbered(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, the words by number, words of each list)."""
    flat = lists.flatten()
    word, names = _coded(flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat)
    return names, word, np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)


def _parts(batch: pa.RecordBatch, most: int = WORDS_AT_A_TIME) -> Iterator[pa.RecordBatch]:
    """A batch in slices of whole rows, of about `most` words each."""
    ends = np.cumsum(np.asarray(pc.list_value_length(batch.column("words")), np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def _words(df: DataFrame, col: str, *keep: str) -> DataFrame:
    return drop_blank(df, col).select(*keep, words(F.col(col)).alias("words"))


#: Bytes of text that one task numbers the words of.
TEXT_A_PART = 32 << 20


def numbered_texts(df: DataFrame, row_id: str, col: str) -> DataFrame:
    """The rows with text in chunks of some million words, made once: their ids, their numbers of words, their words by number.

    (chunk, ids, lengths, codes, terms): `codes` are places in the chunk's own list of words, `terms`. All rows of one id are in one
    chunk, side by side. Later steps count n-grams from these numbers, and no text is read, moved or split in words again. What the rows
    were is kept beside them: `n_docs`.
    """
    made = vars(df).setdefault("numbered", {})
    if (row_id, col) in made:
        return made[row_id, col]
    texts = drop_blank(df, col).select(row_id, col)
    n_docs, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).first()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TEXT_A_PART))
    ids = texts.schema[row_id].dataType
    layout = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(ids)), T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("terms", T.ArrayType(T.StringType())),
    ])

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_words, number = [], 0, TaskContext.get().partitionId() << CHUNK_BITS

        def chunk(rows: pa.RecordBatch) -> pa.RecordBatch:
            names, word, lengths = _numbered(rows.column("words"))
            arrays = [rows.column(0), pa.array(lengths, pa.int32()), pa.array(word, pa.int32()), names]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[one(a) for a in arrays]], layout.names)

        def together() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for part in (part for batch in batches for part in _parts(batch)):
            held.append(part)
            n_words += pc.sum(pc.list_value_length(part.column("words"))).as_py() or 0
            if n_words < WORDS_A_CHUNK:
                continue
            # The last id may go on in the next rows.
            rows = together()
            cuts = np.flatnonzero(_changes(rows.column(0)))
            if len(cuts):
                yield chunk(rows.slice(0, int(cuts[-1]) + 1))
                held, number = [rows.slice(int(cuts[-1]) + 1)], number + 1
                n_words = pc.sum(pc.list_value_length(held[0].column("words"))).as_py() or 0
        if held:
            yield chunk(together())

    dealt = texts.repartition(parts, row_id).sortWithinPartitions(row_id).select(row_id, words(F.col(col)).alias("words"))
    made[row_id, col] = stored(dealt.mapInArrow(pack, layout), "numbered-texts")
    made[row_id, col].n_docs = n_docs
    return made[row_id, col]


def _counted(df: DataFrame, col: str | None, config: TfidfConfig, sieve: Sieve | None) -> Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, Cells]]]:
    """What counts a batch of texts, or of numbered ones without a `col`, slice by slice, without what the sieve holds back."""
    shared = df.sparkSession.sparkContext.broadcast(sieve) if sieve else None

    def count(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Cells]]:
        for part, numbered in _slices(batch, col is None):
            yield part, _cells(*numbered, config, shared.value if shared else None)

    return count


def _slices(batch: pa.RecordBatch, numbered: bool) -> Iterator[tuple[pa.RecordBatch, tuple[pa.Array, np.ndarray, np.ndarray]]]:
    if not numbered:
        for part in _parts(batch):
            yield part, _numbered(part.column("words"))
        return
    for i in range(batch.num_rows):
        # What counting the chunk before has freed goes back at once.
        pa.default_memory_pool().release_unused()
        row = batch.slice(i, 1)
        names, word, lengths = (row.column(name).flatten() for name in ("terms", "codes", "lengths"))
        yield row, (names, np.asarray(word, np.int64), np.asarray(lengths, np.int64))


def _counting(df: DataFrame, col: str | None, *keep: str) -> DataFrame:
    return df.select(*keep, "lengths", "codes", "terms") if col is None else _words(df, col, *keep)


def document_terms(df: DataFrame, row_id: str, col: str, config: TfidfConfig, sieve: Sieve | None = None) -> DataFrame:
    """(row_id, term, tf) of the rows with text, which `row_id` tells apart; counted in slices of whole rows.

    Terms that `sieve` holds back are gone before they leave the slice.
    """
    count = _counted(df, col, config, sieve)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cells in (found for batch in batches for found in count(batch)):
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(cells.doc)), cells.terms.take(pa.array(cells.term)), pa.array(cells.count, pa.int64())], [row_id, "term", "tf"])

    texts = _words(df, col, row_id)
    schema = T.StructType([texts.schema[row_id], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return texts.mapInArrow(terms, schema)


def sieve_of(df: DataFrame, col: str | None, config: TfidfConfig, least: int, bits: int = SIEVE_BITS) -> Sieve:
    """A sieve for the terms of at least `least` of the texts in `col`; without one, of `numbered_texts`."""
    low, high = config.ngram_range

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, numbered in _slices(batch, col is None):
            for runs in _runs(*numbered, low, high):
                yield runs.hashes[runs.term]

    return Sieve(least, bits).fill(_counting(df, col), hashes)


def term_stats(terms: DataFrame) -> DataFrame:
    """(term, df, cf): documents with the term and its occurrences."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def corpus_stats(df: DataFrame, col: str | None, config: TfidfConfig, sieve: Sieve | None = None) -> DataFrame:
    """`term_stats` of a corpus, of the texts in `col` or without one of `numbered_texts`; a slice of texts sends each of its terms once."""
    count = _counted(df, col, config, sieve)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cells in (found for batch in batches for found in count(batch)):
            n = len(cells.terms)
            occurs = np.bincount(cells.term, cells.count, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([cells.terms, pa.array(np.bincount(cells.term, minlength=n), pa.int64()), pa.array(occurs)], ["term", "df", "cf"])

    parts = _counting(df, col).mapInArrow(partial, "term string, df bigint, cf bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _bound(value: int | float, n_docs: int) -> float:
    return value * n_docs if isinstance(value, float) else value


def _sieve_bits(numbered: DataFrame) -> int:
    n_words = numbered.agg(F.sum(F.size("codes"))).first()[0] or 0
    return min(max(int(n_words).bit_length(), SIEVE_BITS), MOST_SIEVE_BITS)


def fit_tfidf(df: DataFrame, row_id: str, col: str, config: TfidfConfig | None = None) -> TfidfModel:
    """Vocabulary and idf of a corpus; terms are numbered in alphabetical order.

    The texts are split in words and stored as numbers once (`numbered_texts`). Where a term needs several documents, a sketch of
    all terms comes first, so that only terms which may have as many are shuffled and counted; most n-grams occur once.
    """
    config = config or TfidfConfig()
    numbered = numbered_texts(df, row_id, col)
    n_docs = numbered.n_docs
    least = math.ceil(_bound(config.min_df, n_docs))
    sieve = sieve_of(numbered, None, config, least, _sieve_bits(numbered)) if least > 1 else None
    stats = corpus_stats(numbered, None, config, sieve).where(
        (F.col("df") >= _bound(config.min_df, n_docs)) & (F.col("df") <= _bound(config.max_df, n_docs))
    )
    # Numbering by ranges reads its rows twice.
    stats = stored(stats, "term-stats")
    if config.max_features is not None:
        stats = top_n(stats, [F.desc("cf"), "term"], config.max_features)
    smooth = 1 if config.smooth_idf else 0
    idf = F.log((F.lit(n_docs) + smooth) / (F.col("df") + smooth).cast("double")) + 1.0
    vocabulary = with_sequential_id(
        stats.withColumn("idf", idf if config.use_idf else F.lit(1.0)), ["term"], "term_id", start=0
    )
    return TfidfModel(vocabulary.select("term_id", "term", "df", "cf", "idf"), n_docs, config, row_id, col, sieve)


def transform_tfidf(model: TfidfModel, df: DataFrame) -> DataFrame:
    """(row_id, term_id, term, weight): the non-zero cells of the matrix.

    Texts move once, whole. A vocabulary that was measured to be small is sent to them. Else the chunks of `numbered_texts`, which those
    that the model was fitted to have already, look each of their terms up once, however many of their texts have it.
    """
    config, row_id = model.config, model.row_id
    known = model.vocabulary.select("term", "term_id", "idf")
    if not is_small(known):
        return _transform_chunks(model, numbered_texts(df, row_id, model.col), known)
    texts = df.select(row_id, model.col).repartition(row_id)
    # Counted inside the row: every later step per document then finds its rows in place.
    terms = drop_blank(texts, model.col).select(row_id, F.inline(counted(ngrams(words(F.col(model.col)), *config.ngram_range))))
    cells = terms.join(F.broadcast(known), ["term"], "inner")
    tf = F.col("tf").cast("double")
    cells = cells.withColumn("raw", (F.log(tf) + 1.0 if config.sublinear_tf else tf) * F.col("idf"))
    if config.norm == "l2":
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(row_id)))
    elif config.norm == "l1":
        length = F.sum("raw").over(Window.partitionBy(row_id))
    else:
        length = F.lit(1.0)
    return cells.select(row_id, "term_id", "term", (F.col("raw") / length).alias("weight"))


def _changes(ids: pa.Array) -> np.ndarray:
    """For each but the first value whether it differs from the one before; null equals null."""
    here, before = ids.slice(1), ids.slice(0, max(len(ids) - 1, 0))
    both = pc.and_(pc.is_null(here), pc.is_null(before))
    return ~np.asarray(pc.or_(pc.fill_null(pc.equal(here, before), False), both))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by significance of their bytes, so that what moves of them compresses well."""
    return np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(planes: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes.as_buffer(), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _strings(terms: pa.Array) -> tuple[np.ndarray, bytes]:
    """(lengths in bytes, all terms one after the other)."""
    lengths = np.asarray(pc.binary_length(terms), np.int64)
    start = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset] if len(terms) else 0
    return lengths, bytes(terms.buffers()[2][start : start + int(lengths.sum())]) if lengths.any() else b""


def _terms_of(lengths: pa.Scalar, terms: pa.Scalar) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(_from_planes(lengths))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), terms.as_buffer())


def _by_part(terms: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(order of terms by part and name, the parts that they have, start and end of each in that order)."""
    part = (pd.util.hash_array(np.asarray(terms.to_numpy(zero_copy_only=False), object), categorize=False) % np.uint64(n)).astype(np.int64) if len(terms) else np.zeros(0, np.int64)
    order = np.asarray(pc.sort_indices(terms), np.int64)
    order = order[np.argsort(part[order], kind="stable")]
    starts = np.flatnonzero(np.append(np.full(min(len(part), 1), True), part[order][1:] != part[order][:-1]))
    return order, part[order][starts], list(zip(starts.tolist(), [*starts[1:].tolist(), len(part)]))


WANTED = "part bigint, of_chunk bigint, at binary, lengths binary, terms binary"
KNOWN = "part bigint, lengths binary, terms binary, term_ids binary, idfs binary"
FOUND = "of_chunk bigint, at binary, term_ids binary, idfs binary, idf_codes binary"


def _looked_up(model: TfidfModel, numbered: DataFrame, known: DataFrame, count: Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, Cells]]]) -> DataFrame:
    """What chunks find of their terms: a row for a chunk and a part of the vocabulary, of the terms' places in the chunk, numbers and idf.

    Parts follow from the terms. Both sides send a row of packed terms for each of theirs, so strings are neither rows of a shuffle nor of a join.
    """
    spark = numbered.sparkSession
    n = max(LEAST_PARTS, 2 * spark.sparkContext.defaultParallelism, known.count() >> PART_BITS, numbered.count() >> CHUNKS_A_PART_BITS)

    def want(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, cells in (found for batch in batches for found in count(batch)):
            order, parts, cuts = _by_part(cells.terms, n)
            terms, chunk = cells.terms.take(pa.array(order)), row.column("chunk")[0].as_py()
            packed = [(_planes(order[start:end]), *_strings(terms.slice(start, end - start))) for start, end in cuts]
            columns = [[p[0] for p in packed], [_planes(p[1]) for p in packed], [p[2] for p in packed]]
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(np.full(len(parts), chunk, np.int64)), *[pa.array(c, pa.binary()) for c in columns]], ["part", "of_chunk", "at", "lengths", "terms"])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, parts, cuts = _by_part(batch.column("term"), n)
            rows, out = batch.take(pa.array(order)), []
            for start, end in cuts:
                own = rows.slice(start, end - start)
                lengths, terms = _strings(own.column("term"))
                out.append((_planes(lengths), terms, _planes(np.asarray(own.column("term_id"))), np.asarray(own.column("idf"), np.float64).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(parts), *[pa.array([r[i] for r in out], pa.binary()) for i in range(4)]], ["part", "lengths", "terms", "term_ids", "idfs"])

    def meet(wanted: pa.Table, held: pa.Table) -> pa.Table:
        terms = pa.concat_arrays([pa.array([], pa.string()), *[_terms_of(a, b) for a, b in zip(held.column("lengths"), held.column("terms"))]])
        ids = np.concatenate([np.zeros(0, np.int64), *[_from_planes(a) for a in held.column("term_ids")]])
        idfs = np.concatenate([np.zeros(0), *[np.frombuffer(a.as_buffer(), np.float64) for a in held.column("idfs")]])
        out = []
        sizes = [len(_from_planes(a)) for a in wanted.column("at")]
        asked = pa.concat_arrays([pa.array([], pa.string()), *[_terms_of(a, b) for a, b in zip(wanted.column("lengths"), wanted.column("terms"))]])
        places = np.asarray(pc.fill_null(pc.index_in(asked, terms), -1), np.int64)
        for at, place in zip(wanted.column("at"), np.split(places, np.cumsum(sizes)[:-1])):
            met, place = _from_planes(at)[place >= 0], place[place >= 0]
            different, code = np.unique(idfs[place], return_inverse=True)
            # Terms are in order of their names, as their numbers are.
            out.append((_planes(met), _planes(np.diff(ids[place], prepend=0)), different.tobytes(), _planes(code)))
        return pa.table([wanted.column("of_chunk"), *[pa.array([r[i] for r in out], pa.binary()) for i in range(4)]], ["of_chunk", "at", "term_ids", "idfs", "idf_codes"])

    wanted = numbered.select("chunk", "lengths", "codes", "terms").mapInArrow(want, WANTED)
    held = known.select("term", F.col("term_id").cast("bigint").alias("term_id"), "idf").mapInArrow(give, KNOWN)
    return wanted.groupBy("part").cogroup(held.groupBy("part")).applyInArrow(meet, FOUND)


def _transform_chunks(model: TfidfModel, numbered: DataFrame, known: DataFrame) -> DataFrame:
    """`transform_tfidf` for a vocabulary of any size, of `numbered_texts`.

    Only the terms of a chunk are shuffled to meet the vocabulary, each with its place among them; what they find comes back to
    the chunk, whose n-grams are counted again from the numbers of its words. Cells leave in slices.
    """
    config, row_id = model.config, model.row_id
    count = _counted(numbered, None, config, model.sieve)
    ids = T.StructField(row_id, numbered.schema["ids"].dataType.elementType)
    out = T.StructType([ids, T.StructField("term_id", T.LongType()), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    found = _looked_up(model, numbered, known, count)

    def weigh(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, told = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("codes")[i].is_valid:
                    chunk = batch.slice(i, 1)
                else:
                    at, term_ids, codes = (_from_planes(batch.column(name)[i]) for name in ("at", "found_ids", "idf_codes"))
                    told.append((at, np.cumsum(term_ids), np.frombuffer(batch.column("idfs")[i].as_buffer(), np.float64)[codes]))
        for row, cells in count(chunk):
            own = row.column("ids").flatten()
            # Rows of one id are one document to the length of its vector.
            same = np.concatenate([[0], np.cumsum(_changes(own))])
            known, term_id, idf = np.zeros(len(cells.terms), bool), np.zeros(len(cells.terms), np.int64), np.zeros(len(cells.terms))
            for at, numbers, values in told:
                known[at], term_id[at], idf[at] = True, numbers, values
            met = known[cells.term]
            doc, term, tf = cells.doc[met], cells.term[met], cells.count[met].astype(np.float64)
            raw = (np.log(tf) + 1.0 if config.sublinear_tf else tf) * idf[term]
            if config.norm == "l2":
                raw = raw / np.sqrt(np.bincount(same[doc], raw * raw))[same[doc]]
            elif config.norm == "l1":
                raw = raw / np.bincount(same[doc], raw)[same[doc]]
            for start in range(0, len(raw), CELLS_OUT):
                of, t = doc[start : start + CELLS_OUT], term[start : start + CELLS_OUT]
                yield pa.RecordBatch.from_arrays([own.take(pa.array(of)), pa.array(term_id[t]), cells.terms.take(pa.array(t)), pa.array(raw[start : start + CELLS_OUT])], out.names)

    # Both kinds of rows come to the chunk as one stream; a row has either what the chunk is or what it found.
    no = lambda name: F.lit(None).cast(numbered.schema[name].dataType).alias(name)
    nothing = [F.lit(None).cast("binary").alias(name) for name in ("at", "found_ids", "idfs", "idf_codes")]
    texts = numbered.select("chunk", "ids", "lengths", "codes", "terms", *nothing)
    both = texts.unionAll(found.select(F.col("of_chunk").alias("chunk"), *map(no, ("ids", "lengths", "codes", "terms")), "at", F.col("term_ids").alias("found_ids"), "idfs", "idf_codes"))
    return both.groupBy("chunk").applyInArrow(weigh, out)


def idf_table(model: TfidfModel) -> DataFrame:
    """(term, idf), highest idf first."""
    return model.vocabulary.select("term", "idf").orderBy(F.desc("idf"), "term")


def common_terms(model: TfidfModel, n: int = 10) -> DataFrame:
    return model.vocabulary.select("term", "idf").orderBy("idf", "term").limit(n)


def rare_terms(model: TfidfModel, n: int = 10) -> DataFrame:
    return idf_table(model).limit(n)


def embedding_shape(model: TfidfModel, weights: DataFrame) -> DataFrame:
    """One row: n_docs, n_terms, nnz and density (share of non-zero cells)."""
    n_terms = model.vocabulary.agg(F.count(F.lit(1))).scalar()
    counts = weights.agg(F.count(F.lit(1)).alias("nnz"))
    return counts.select(
        F.lit(model.n_docs).cast("bigint").alias("n_docs"),
        n_terms.alias("n_terms"),
        "nnz",
    ).withColumn("density", F.col("nnz") / (F.col("n_docs").cast("double") * F.col("n_terms")))


def top_terms(weights: DataFrame, row_id: str, n: int = 10) -> DataFrame:
    """The heaviest terms of every document."""
    return top_n_per_group(weights, [row_id], [F.desc("weight"), "term"], n)


def packed_vectors(weights: DataFrame, row_id: str) -> DataFrame:
    """(row_id, term_ids, weights): a document's cells as two arrays, sorted by term."""
    cell = F.struct(F.col("term_id").cast("bigint").alias("term_id"), F.col("weight").cast("double").alias("weight"))
    cells = weights.groupBy(row_id).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return cells.select(row_id, F.col("cells.term_id").alias("term_ids"), F.col("cells.weight").alias("weights"))


def dot_products(batch: pa.RecordBatch) -> np.ndarray:
    """The sum of products over shared terms of the vectors a and b of each row; a missing vector is empty."""

    def cells(side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        terms = batch.column(f"term_ids_{side}")
        lengths = np.asarray(pc.fill_null(pc.list_value_length(terms), 0))
        return np.repeat(np.arange(batch.num_rows), lengths), np.asarray(terms.flatten(), np.int64), np.asarray(batch.column(f"weights_{side}").flatten(), np.float64)

    (row_a, term_a, weight_a), (row_b, term_b, weight_b) = cells("a"), cells("b")
    if not len(term_a) or not len(term_b):
        return np.zeros(batch.num_rows)
    # Both sides are in order of (row, term), so one merge finds the shared cells of all pairs.
    span = max(int(term_a.max()), int(term_b.max())) + 1
    key_a, key_b = row_a * span + term_a, row_b * span + term_b
    at = np.minimum(np.searchsorted(key_b, key_a), len(key_b) - 1)
    met = key_b[at] == key_a
    return np.bincount(row_a[met], weight_a[met] * weight_b[at[met]], batch.num_rows)


def cosine_pairs(weights: DataFrame, pairs: DataFrame, row_id: str) -> DataFrame:
    """(a, b, cosine) of the given pairs of documents; rows have length 1, so a dot product.

    A document is one row of two sorted arrays. The pairs look their two documents up, and one merge of the
    arrays multiplies a batch of pairs, so nothing is exploded per pair. A document of many pairs is
    spread: its pairs are dealt to as many parts as there are thousands of them, each of which gets a copy of the row.
    """
    vectors = stored(packed_vectors(weights, row_id), "vectors")
    named = stored(pairs.select("a", "b").distinct(), "pairs")

    def looked_up(left: DataFrame, key: str) -> DataFrame:
        own = vectors.select(F.col(row_id).alias(key), F.col("term_ids").alias(f"term_ids_{key}"), F.col("weights").alias(f"weights_{key}"))
        sizes = named.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= PAIRS_A_PART:
            return left.join(own, key, "left")
        parts = sizes.select(key, F.ceil(F.col("n") / PAIRS_A_PART).cast("int").alias("parts"))
        copies = parts.join(own, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        other = "b" if key == "a" else "a"
        numbered = left.join(parts, key).withColumn("part", F.pmod(F.xxhash64(other), F.col("parts")).cast("int")).drop("parts")
        return numbered.join(copies, [key, "part"], "left").drop("part")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(dot_products(batch))], ["a", "b", "cosine"])

    both = looked_up(looked_up(named, "a"), "b")
    kinds = dict(named.dtypes)
    return both.mapInArrow(multiply, f"a {kinds['a']}, b {kinds['b']}, cosine double")


def _listed(terms: DataFrame, order: list[str]) -> DataFrame:
    """One row with the (few) terms of a table in order, joined by ', '."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, "term")))
    return terms.agg(F.array_join(F.transform(pairs, lambda p: p["term"]), ", ").alias("terms"))


def embedding_summary(model: TfidfModel, weights: DataFrame, example: object) -> DataFrame:
    """One row: shape, density, common and rare terms, heaviest terms of one document."""
    common = _listed(common_terms(model), ["idf"])
    rare = _listed(rare_terms(model).withColumn("order", -F.col("idf")), ["order"])
    mine = weights.where(F.col(model.row_id) == example).orderBy(F.desc("weight"), "term").limit(10)
    mine = _listed(mine.withColumn("order", -F.col("weight")), ["order"])
    return embedding_shape(model, weights).select(
        "n_docs",
        "n_terms",
        "density",
        common.scalar().alias("common_terms"),
        rare.scalar().alias("rare_terms"),
        mine.scalar().alias("example_terms"),
    )


def write_tfidf(weights: DataFrame, path: str, row_id: str) -> None:
    """The matrix as parquet: row_id, term_id, weight (32 bit)."""
    weights.select(row_id, "term_id", F.col("weight").cast("float").alias("weight")).write.parquet(path)


def config_frame(model: TfidfModel) -> DataFrame:
    """The configuration as a one-row table."""
    values = asdict(model.config)
    values["ngram_range"] = list(values["ngram_range"])
    return model.vocabulary.sparkSession.createDataFrame(
        [tuple(values.values())],
        "ngram_range array<int>, min_df string, max_df string, max_features int, norm string, "
        "use_idf boolean, smooth_idf boolean, sublinear_tf boolean, dtype string",
    )


def write_config(model: TfidfModel, path: str) -> None:
    """One JSON line with the configuration."""
    frame = config_frame(model)
    for name in ("min_df", "max_df"):
        kind = "double" if isinstance(getattr(model.config, name), float) else "bigint"
        frame = frame.withColumn(name, F.col(name).cast(kind))
    frame.coalesce(1).write.option("ignoreNullFields", False).json(path)


def save_model(model: TfidfModel, path: str) -> None:
    model.vocabulary.write.parquet(f"{path}/vocabulary")
    write_config(model, f"{path}/config")
    spark = model.vocabulary.sparkSession
    spark.createDataFrame(
        [(model.n_docs, model.row_id, model.col)], "n_docs bigint, row_id string, col string"
    ).coalesce(1).write.json(f"{path}/fit")


def load_model(spark: SparkSession, path: str) -> TfidfModel:
    values = json.loads(spark.read.text(f"{path}/config").first()[0])
    values["ngram_range"] = tuple(values["ngram_range"])
    fit = spark.read.schema("n_docs bigint, row_id string, col string").json(f"{path}/fit").first()
    return TfidfModel(
        spark.read.parquet(f"{path}/vocabulary"), fit["n_docs"], TfidfConfig(**values), fit["row_id"], fit["col"]
    )
