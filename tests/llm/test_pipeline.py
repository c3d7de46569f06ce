"""The pipeline: stages on awkward rows and on the given tables."""

import random
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm.registry import table
from tests.llm.data import CLASHES, SF, awkward, read, rows_of, text, write
from tests.llm.test_jaccard_join import brute
from tests.llm.test_tokens import crc


def stages(spark, sf):
    """(name, rows in, rows out) of every stage."""
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        made = stage(spark, docs, sf).toArrow()
        out.append((name, before.toArrow().to_pylist(), made.to_pylist()))
        docs = spark.createDataFrame(made, before.schema) if name != "packing" else made
    return out


def ids_of(rows):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows)


def test_stages_on_awkward_rows(spark, tmp_path):
    rng = random.Random(25)
    docs = awkward(rng, 80)
    docs += [(1000 + i, text(rng, 40).upper().replace(" ", "!! "), "en", "a", None) for i in range(40)]
    docs += [(2000 + i, docs[3][1] + " tail", "en", "b", None) for i in range(5)]
    labels = [(i, 1, 0) for i in range(80)] + [(1000 + i, 0, 0) for i in range(40)]
    sf = write(tmp_path, True, documents=docs, labels=labels)
    done = stages(spark, sf)
    for name, before, after in done[:-1]:
        assert not after or set(after[0]) == set(before[0]), name
        assert not after or after[0]["hash"] == "hash!"
        rest = [str(r) for r in before]
        assert all(str(r) in rest for r in after), name
    good = {r["doc_id"] for r in done[0][2]}
    assert good >= set(range(80)) and not good & set(range(1000, 1040))
    assert not [r for r in done[1][2] if not re.search(r"[^\W\d_]", r["text"] or "")]
    assert {r["doc_id"] for r in done[1][2]} >= set(range(80))
    kept = brute(done[2][1])
    assert ids_of(done[2][2]) == sorted((True, d) for d in {c for _, _, c in kept})
    assert ids_of(done[3][2]) and {r["doc_id"] for r in done[3][2]} <= {r["doc_id"] for r in done[2][2]}
    assert sum(r["length"] for r in done[4][2]) == sum(len(whole(r["text"])) for r in done[3][2])
    assert "hash" in CLASHES


WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(t):
    return [*WHOLE.encode(t or "", add_special_tokens=False).ids, 1]


def test_run_on_the_given_tables(spark):
    got = rows_of(corpus_pipeline.run(spark, SF))
    texts = {r["doc_id"]: whole(r["text"]) for r in read(SF, "documents")}
    assert got and all(crc(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]) == r["ids_crc32"] for r in got)
    per = {}
    for r in got:
        per[r["sequence_id"]] = per.get(r["sequence_id"], 0) + r["length"]
    lengths = np.array([per[k] for k in sorted(per)])
    assert ((lengths == 2048) | (lengths & (lengths - 1) == 0)).all()


def test_empty_tables(spark, tmp_path):
    assert rows_of(corpus_pipeline.run(spark, write(tmp_path, documents=[], labels=[]))) == []


def jaccard(a, b, width):
    sets = [{tuple(w[i : i + width]) for i in range(len(w) - width + 1)} for w in (a.split(), b.split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_are_those_of_five_words_at_four_fifths(spark):
    rng, rows, kept = random.Random(31), [], []
    for k in range(12):
        words = [f"w{k}x{i}" for i in range(200)]
        # Some single words replaced, or a new end, for shares around the limit.
        at = rng.sample(range(10, 190), 1 + k)
        copy = [f"new{i}" if i in at else w for i, w in enumerate(words)] if k % 2 else words[: 174 + 2 * k] + [f"end{i}" for i in range(26 - 2 * k)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
        kept += [2 * k] + [2 * k + 1] * (jaccard(rows[-1][1], rows[-2][1], 5) < 0.8)
    pairs = [(rows[i][1], rows[i + 1][1]) for i in range(0, len(rows), 2)]
    assert any(0.8 <= jaccard(a, b, 5) < 0.85 and jaccard(a, b, 4) < 0.85 for a, b in pairs) and any(jaccard(a, b, 5) < 0.8 for a, b in pairs)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert ids_of(rows_of(corpus_pipeline.keep_one_of_each_group(spark, docs, ""))) == [(True, d) for d in kept]


def test_survivors_are_told_apart_by_row_not_by_id(spark):
    rng = random.Random(32)
    a, b, c, d, e = (text(rng, 60) for _ in range(5))
    rows = [(None, a, "null id, unlinked"), (7, b, "shared id"), (7, c, "shared id, other text"), (1, d, "least of three"), (None, d, "copy"), (5, d, "copy"), (9, e, "twice"), (9, e, "twice")]
    rows += [(None, None, "null"), (None, None, "null"), (3, "", "empty"), (3, " ", "blank"), (None, b + " tail", "near copy of the first 7")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, note string")
    got = sorted(r["note"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect())
    assert got == sorted(["null id, unlinked", "shared id", "shared id, other text", "least of three", "twice", "null", "null", "empty", "blank"])
    assert corpus_pipeline.keep_one_of_each_group(spark, docs, "").columns == docs.columns
