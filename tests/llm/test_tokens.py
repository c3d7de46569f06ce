"""Token ids: the encoder against the library, files and packing against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsloom.llm import packing, token_files, tokens
from newsloom.llm.registry import QUERIES
from newsloom.session import scratch_dir
from tests.llm.data import awkward, read, rows_of, write

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40) | st.text("aB'st é ñ\t\n\x0b\x1c\x85\xa0İıſΣ<|endoft>0123½漢́", max_size=40))
def test_encoder_equals_the_library(text):
    own = tokens.encoder(PATH)
    assert np.frombuffer(own.encode(text), own.dtype).tolist() == ids(text)


def test_other_kinds_of_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, text = tokens.Encoder(path), " Two  blanks\n\nand é漢 <|endoftext|>"
    assert own.pattern is None
    assert np.frombuffer(own.encode(text), own.dtype).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_memory_of_the_encoder_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    own, rng = tokens.Encoder(PATH), random.Random(8)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abc") for _ in range(4)) for _ in range(5))
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == ids(text)
    assert all(len(m) <= 5 and len(m.older) <= 5 for m in (own.words, own.pieces))
    own.rest()
    assert not own.words.older and not own.pieces.older


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24])))
def test_numbers_come_back(numbers):
    control, data = token_files.encode_numbers(np.array(numbers, np.uint32))
    assert len(control) == -(-len(numbers) // 4)
    assert token_files.decode_numbers(control, data, len(numbers)).tolist() == numbers


def test_files_of_awkward_rows(spark, tmp_path):
    sf = write(tmp_path, True, documents=awkward(random.Random(9), 70) + [(None, "null id", None, None, None), (-5, "first", None, None, None)])
    got = rows_of(QUERIES["op8_token_files"](spark, sf))
    order = sorted(read(sf, "documents"), key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0))
    at, want = 0, []
    for d in order:
        own = [*ids(d["text"]), 2]
        want.append((d["doc_id"], at, len(own), crc(own)))
        at += len(own)
    low = lambda r: (r[0] is not None, r)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: (r[0] is not None, r[1])) == sorted(want, key=lambda r: (r[0] is not None, r[1])), low
    assert rows_of(QUERIES["op8_token_files"](spark, write(tmp_path, documents=[]))) == []


def test_small_blocks_and_ranks(spark, tmp_path):
    sf = write(tmp_path, documents=awkward(random.Random(10), 40))
    folder = scratch_dir(spark, "files")
    token_files.write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), PATH, folder, block_ids=100)
    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.count() > 10 and blocks.where("total > 100 and size(doc_ids) > 1").count() == 0
    got = {(r["doc_id"], r["start"]): np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read_tokens(spark, folder).collect()}
    for d in read(sf, "documents"):
        assert [*ids(d["text"]), 2] in [v for k, v in got.items() if k[0] == d["doc_id"]]
    counted = np.bincount(np.concatenate(list(got.values())))
    ranks = [counted[r["id"]] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    assert ranks == sorted(ranks, reverse=True)


def check_pieces(docs, got, window=2048):
    want = sorted(crc([*ids(d["text"]), 1]) for d in docs)
    by_place, total = {}, 0
    for r in got:
        assert by_place.setdefault((r["sequence_id"], r["offset"]), r) is r
        total += r["length"]
    at = {}
    for (sequence, offset), r in sorted(by_place.items()):
        assert offset == at.get(sequence, 0) and r["length"] > 0
        at[sequence] = offset + r["length"]
    assert sorted(at) == list(range(len(at)))
    assert all(n == window or (n < window and n & (n - 1) == 0) for n in at.values())
    assert total == sum(len(ids(d["text"])) + 1 for d in docs)
    return want


@pytest.mark.parametrize("rows", [3, 150])
def test_packing_of_awkward_rows(spark, tmp_path, rows):
    sf = write(tmp_path, True, documents=awkward(random.Random(11), rows))
    docs, got = read(sf, "documents"), rows_of(QUERIES["op10_pack_sequences"](spark, sf))
    check_pieces(docs, got)
    once = {}
    for d in docs:
        once.setdefault(d["doc_id"], []).append([*ids(d["text"]), 1])
    for r in got:
        assert any(crc(o[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] and len(o) == r["doc_tokens"] for o in once[r["doc_id"]])
    for doc_id, texts in once.items():
        if len(texts) == 1:
            own = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == doc_id)
            assert [s for s, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) == len(texts[0])


def test_windows_hold_the_proportions(spark, tmp_path):
    docs = [(i, "word " * 50, None, "big" if i % 2 else f"s{i % 5}", None) for i in range(900)] + [(1000, "tiny", None, "tiny", None)]
    pieces = packing.pack(spark.read.parquet(f"{write(tmp_path, documents=docs)}/documents.parquet"), PATH, window=256)
    per = pieces.groupBy("sequence_id", "queue").sum("length").collect()
    share = {}
    for r in per:
        share.setdefault(r["queue"], []).append(r["sum(length)"])
    total = sum(map(sum, share.values()))
    full = total // 256
    for queue, lengths in share.items():
        earned = 256 * sum(lengths) / total
        own = [r["sum(length)"] for r in per if r["queue"] == queue and r["sequence_id"] < full]
        assert all(abs(n - earned) < 2 for n in own), queue


def test_no_rows(spark, tmp_path):
    assert rows_of(QUERIES["op10_pack_sequences"](spark, write(tmp_path, documents=[]))) == []
    got = rows_of(QUERIES["op10_pack_sequences"](spark, write(tmp_path, documents=[(1, None, None, None, None)])))
    assert [(r["length"], r["ids_crc32"], r["sequence_id"], r["offset"]) for r in got] == [(1, crc([1]), 0, 0)]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**40), st.integers(1, 2**45), st.data())
def test_shares_are_exact(windows, total, data):
    earned = data.draw(st.integers(0, 2048 * total))
    if windows * (earned // total) < 2**62:
        assert packing.share_floor(np.array([windows]), np.array([earned]), total).tolist() == [windows * earned // total]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(64, 4000), min_size=1, max_size=8), st.randoms())
def test_every_id_has_one_place(sizes, rng):
    plan = packing.Plan(sizes, window=64) if all(s * 64 >= sum(sizes) for s in sizes) else packing.Plan([sum(sizes)], window=64)
    sizes = np.diff(plan.upto).tolist()
    queue, start, length = [], [], []
    for q, size in enumerate(sizes):
        at = 0
        while at < size:
            n = min(size - at, rng.randint(1, 200))
            queue.append(q), start.append(at), length.append(n)
            at += n
    row, s, n, sequence, offset = plan.pieces(*map(np.array, (queue, start, length)))
    places = sorted((a, o + k) for a, o, m in zip(sequence.tolist(), offset.tolist(), n.tolist()) for k in range(m))
    ends = [64] * plan.full + plan.tail
    assert places == [(a, k) for a, e in enumerate(ends) for k in range(e)]
