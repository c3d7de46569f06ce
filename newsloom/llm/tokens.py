"""Whole texts to token ids with the tokenizers library, inside Arrow batches.

Spark deals out the rows; a worker process keeps one encoder. Arrow splits the texts of a slice of rows
at blanks and numbers their different pieces; only those are looked at in Python, and the ids of
all are gathered by their numbers. Words recur, so an encoder remembers the ids of pieces and of the words
within them, up to a bound, and asks the library only for new ones. That gives the ids of the whole
text because blanks separate words in such tokenizers; for other kinds, and pieces with characters
outside the plainest scripts, the library encodes the whole piece or text.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

REMEMBERED = 200_000
WORDS_AT_ONCE = 512
ROWS_AT_ONCE = 256
BYTES_AT_ONCE = 1 << 20
#: Characters whose lower case and normal form depend on nothing around them.
PLAIN = re.compile("[!-~\xa1-\xac\xae-\u012f\u0131-\u024f]*")
MARKS = ".,;:!?"
LETTER = "a-zA-Z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{12f}\\x{131}-\\x{1ba}"
WORD_AND_MARK = f"^[{LETTER}]+[{MARKS}]?$"


class Memory(dict):
    """What a function gave for its last arguments: at least REMEMBERED of them, at most twice as many."""

    def __init__(self, compute_all) -> None:
        self.compute_all, self.older = compute_all, {}

    def find_all(self, keys: list[str]) -> list[bytes]:
        """The values of different keys; unknown ones are computed together."""
        found = [*map(self.get, keys)]
        fresh = {}
        for i in [i for i, v in enumerate(found) if v is None]:
            found[i] = self.older.get(keys[i])
            fresh[keys[i]] = found[i]
        unknown = [k for k, v in fresh.items() if v is None]
        fresh.update(zip(unknown, self.compute_all(unknown)))
        if len(self) + len(fresh) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        self.update(fresh)
        return [fresh[k] if v is None else v for k, v in zip(keys, found)]


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.pattern = self._word_pattern(json.loads(self.whole.to_str()))
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        ends = self.whole.get_vocab_size()
        self.ends_word = np.zeros(ends, bool)
        self.ends_word[[i for t, i in self.whole.get_vocab().items() if t.endswith("</w>") and i < ends]] = True
        self.words, self.pieces = Memory(self._words), Memory(lambda pieces: [*map(self._piece, pieces)])

    @staticmethod
    def _word_pattern(config: dict):
        """The pattern of words if blanks and it alone separate them, else None."""
        parts = [p["type"] for p in (config.get("normalizer") or {}).get("normalizers", [])]
        before = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if parts != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in before] != ["Split", "ByteLevel"]:
            return None
        split, model = before[0], config["model"]
        simple = split["behavior"] == "Removed" and split["invert"] and not before[1]["use_regex"] and not before[1]["add_prefix_space"]
        if not simple or model["type"] != "BPE" or model.get("dropout") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"]):
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _spelled(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return self._packed([t.id for t in self.whole.model.tokenize(spelled)])

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of words of lower-case letters; the library gets many at once, and each word's last id ends it."""
        out = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            ids = np.array(self.whole.encode(" ".join(some), add_special_tokens=False).ids, self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                out += map(self._spelled, some)
                continue
            packed, size = ids.tobytes(), self.dtype.itemsize
            bounds = [0, *(ends * size).tolist()]
            out += [packed[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _piece(self, piece: str) -> bytes:
        if PLAIN.fullmatch(piece) and "<|" not in piece:
            return b"".join(map(self._spelled, self.pattern.findall(piece.lower())))
        return self._packed(self.whole.encode(piece, add_special_tokens=False).ids)

    def _known(self, pieces: pa.Array) -> pa.Array:
        """The ids of different pieces; most are a word, or a word and a mark."""
        simple = pc.match_substring_regex(pieces, WORD_AND_MARK)
        own, rest = pieces.filter(simple), pieces.filter(pc.invert(simple)).to_pylist()
        words = pc.utf8_lower(pc.utf8_rtrim(own, MARKS)).dictionary_encode()
        ids = pa.array(self.words.find_all(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        last = pc.utf8_slice_codeunits(own, -1)
        marks = pa.array([self._spelled(m) for m in MARKS], pa.large_binary())
        nothing = pa.scalar(b"", pa.large_binary())
        ids = pc.binary_join_element_wise(ids, pc.fill_null(marks.take(pc.index_in(last, pa.array([*MARKS], own.type))), nothing), nothing)
        place = np.empty(len(pieces), np.int64)
        mask = np.asarray(simple)
        place[mask], place[~mask] = np.arange(len(own)), len(own) + np.arange(len(rest))
        return pa.concat_arrays([ids, pa.array(self.pieces.find_all(rest), pa.large_binary())]).take(pa.array(place))

    def rest(self) -> None:
        """Let go of what was not met lately, as at the end of a task: the process may live on without one."""
        self.words.older, self.pieces.older = {}, {}

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian integers of `dtype`."""
        return self.encode_all(pa.array([text], pa.large_string()))[0].tobytes()

    def encode_all(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text; nulls are empty."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        if self.pattern is None:
            return [np.frombuffer(self._packed(self.whole.encode(t, add_special_tokens=False).ids), self.dtype) for t in texts.to_pylist()]
        lists = pc.split_pattern(pc.replace_substring_regex(texts, "[\n\t\r]", " "), " ")
        pieces = lists.values.slice(lists.offsets[0].as_py(), len(lists.values)).dictionary_encode()
        gathered = self._known(pieces.dictionary).take(pieces.indices)
        ends = np.frombuffer(gathered.buffers()[1], np.int64)[gathered.offset :][: len(gathered) + 1]
        bounds = (ends - ends[0])[np.asarray(lists.offsets) - lists.offsets[0].as_py()] // self.dtype.itemsize
        ids = np.frombuffer(gathered.buffers()[2] or b"", self.dtype, int(bounds[-1]), int(ends[0]))
        return np.split(ids, bounds[1:-1])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def id_type(path: str) -> np.dtype:
    return encoder(path).dtype


def crc32_of(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


def slices(batch: pa.RecordBatch, rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_slices(batch: pa.RecordBatch, text: str, size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `size` bytes of text, at least one row."""
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


TOKENIZED = [
    T.StructField("part", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("start_in_part", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]


def tokenized(docs: DataFrame, path: str, end_id: int, by: str | None = None, text: str = "text") -> DataFrame:
    """The other columns of `docs` with `ids` (packed, the end id last) and `n_tokens`.

    `part` numbers the task; `start_in_part` counts the ids of earlier rows of the same task
    and the same value of column `by`. A null text is empty.
    """
    others = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*others, *TOKENIZED])
    names = [f.name for f in others]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], own.dtype).tobytes()
        so_far = {}
        for big in batches:
            for batch in text_slices(big, text):
                ids = own.encode_all(batch.column(text))
                counts = [len(i) + 1 for i in ids]
                packed = [i.tobytes() + end for i in ids]
                groups = batch.column(by).to_pylist() if by else [None] * len(packed)
                starts = []
                for group, n in zip(groups, counts):
                    starts.append(so_far.get(group, 0))
                    so_far[group] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in names],
                        pa.array([part] * len(packed), pa.int32()),
                        pa.array(counts, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    [*names, *[f.name for f in TOKENIZED]],
                )
        own.rest()

    return docs.mapInArrow(encode, schema)
