"""Token ids in a compact binary file format (operator 8).

Ids are replaced by their rank in frequency, so that the commonest 256 take one byte. Ranks are
written in one to four bytes, little end first; a separate control byte holds the lengths of four
ranks, two bits each. Blocks of whole documents hold control and data bytes apart, with the ids and
lengths of their documents. Reading looks the lengths of a control byte up in a table of 256 rows
and gathers all ranks of a block at once.

Files (`write_tokens`): `blocks`, in ascending order of document id by (part, block), and `ranks`, the id of
each rank. Spark's writers make them, so lost tasks leave no trace, and any store Spark reads will do.

Cases: a null or empty text has the end id only; repeated document ids are kept, in order of
their ids; null ids come first; an empty table gives empty files and no rows; a document is
never cut, so a very long one is a block of its own. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import parallelism
from newsloom.llm.registry import query, table
from newsloom.llm.tokens import crc32_of, id_type, slices, tokenized
from newsloom.operators.joins import lookup_join
from newsloom.session import scratch_dir, stored

BLOCK_IDS = 1 << 20
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: For each control byte the lengths of its four numbers, and the bits a number of each length has.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
BLOCKS = "part int, block bigint, doc_ids array<bigint>, lengths array<bigint>, total bigint, control binary, data binary"


def encode_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit numbers."""
    numbers = numbers.astype("<u4", copy=False)
    extra = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    four = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    four[: len(numbers)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The `count` numbers of (control, data)."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    starts = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    # Four bytes from every start on, of which the length tells how many count.
    wide = np.lib.stride_tricks.as_strided(padded, (max(0, len(padded) - 3), 4), (1, 1))[starts]
    return np.ascontiguousarray(wide).view("<u4").ravel() & KEEP[lengths]


def frequencies(tokens: DataFrame, dtype: np.dtype) -> DataFrame:
    """(id, n) of the ids of all documents; a task sends one row per id it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.int64)
        for big in batches:
            for batch in slices(big):
                n = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype))
                if len(n) > len(seen):
                    seen = np.concatenate([seen, np.zeros(len(n) - len(seen), np.int64)])
                seen[: len(n)] += n
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seen[ids], pa.int64())], ["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def rank_ids(tokens: DataFrame, dtype: np.dtype) -> DataFrame:
    """(rank, id), the most frequent first; at most one row per id of the vocabulary."""
    order = Window.orderBy(F.col("n").desc(), "id")
    return frequencies(tokens, dtype).select((F.row_number().over(order) - 1).alias("rank"), "id")


def _by_rank(ranks: DataFrame) -> np.ndarray:
    """The id of each rank; bounded by the vocabulary."""
    return np.array([r["id"] for r in ranks.orderBy("rank").collect()], np.int64)


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Tokenize the texts of `docs` (doc_id, text) and write `blocks` and `ranks` under `folder`."""
    dtype = id_type(tokenizer_path)
    tokens = stored(tokenized(docs.select("doc_id", "text"), tokenizer_path, end_id).select("doc_id", "n_tokens", "ids"), "token-ids")
    rank_ids(tokens, dtype).write.parquet(f"{folder}/ranks")
    ids = _by_rank(docs.sparkSession.read.parquet(f"{folder}/ranks"))
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, docs_held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            numbers = rank_of[np.concatenate(held)]
            control, data = encode_numbers(numbers)
            row = [part, block, docs_held, [len(h) for h in held], len(numbers), control, data]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()])],
                ["part", "block", "doc_ids", "lengths", "total", "control", "data"],
            )

        for batch in batches:
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(packed.as_buffer(), dtype)
                if held and size + len(ids) > block_ids:
                    yield flush()
                    block, held, docs_held, size = block + 1, [], [], 0
                held.append(ids)
                docs_held.append(doc_id)
                size += len(ids)
        if held:
            yield flush()

    in_order = tokens.select("doc_id", "ids").repartitionByRange(parallelism(docs), "doc_id").sortWithinPartitions("doc_id", "ids")
    in_order.mapInArrow(encode, BLOCKS).write.parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of the files, ids as little-endian 32-bit integers."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    ids = _by_rank(spark.read.parquet(f"{folder}/ranks")).astype("<u4")
    sizes = blocks.select("part", "block", "total")
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row per part meets in one task; blocks are added up within their part.
    parts = sizes.groupBy("part").agg(F.sum("total").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier(Window.orderBy("part"))), F.lit(0)).alias("before"))
    in_part = F.coalesce(F.sum("total").over(earlier(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    starts = stored(sizes.withColumn("in_part", in_part).join(parts, "part").select("part", "block", (F.col("before") + F.col("in_part")).alias("start")), "token-starts")
    placed = lookup_join(blocks, starts, ["part", "block"], ["total"], "inner")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in ("doc_ids", "lengths", "control", "data", "start")}
                lengths = np.asarray(row["lengths"].values, np.int64)
                numbers = decode_numbers(row["control"].as_py(), row["data"].as_py(), int(lengths.sum()))
                real, ends = ids[numbers], np.cumsum(lengths)
                apart = np.split(real, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values,
                        pa.array(row["start"].as_py() + ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([a.tobytes() for a in apart], pa.binary()),
                        pa.array([crc32_of(a) for a in apart], pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    return placed.select("doc_ids", "lengths", "control", "data", "start").mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
