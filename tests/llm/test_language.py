"""Language identification: code lengths against brute force, held-out accuracy, awkward rows."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from newsloom.llm import language
from newsloom.llm.registry import QUERIES
from tests.llm.data import SF, awkward, read, rows_of, text, write

OP = QUERIES["op2_language_id"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def brute_bits(training: list[bytes], data: bytes) -> float:
    """Code length of `data` by the escape rule, straight from counts of contexts."""
    seen: dict[bytes, dict[int, int]] = {}
    for t in training:
        t = b"   " + t
        for i in range(3, len(t)):
            for k in range(4):
                c = seen.setdefault(t[i - k : i], {})
                c[t[i]] = c.get(t[i], 0) + 1

    def chances(context: bytes) -> np.ndarray:
        shorter = chances(context[1:]) if context else np.full(256, 1 / 256)
        here = seen.get(context)
        if not here:
            return shorter
        n, d, out = sum(here.values()), len(here), shorter.copy()
        out[list(here)] = 0
        out *= d / (n + d) / out.sum()
        for b, c in here.items():
            out[b] = c / (n + d)
        return out

    data = b"   " + data
    return sum(-math.log2(chances(data[i - 3 : i])[data[i]]) for i in range(3, len(data)))


def test_code_lengths_equal_brute_force(spark):
    rng = random.Random(12)
    own = {lang: [text(rng, 30, lang) for _ in range(5)] for lang in ("en", "de", "fr")}
    frame = spark.createDataFrame([(t, lang) for lang, ts in own.items() for t in ts], "text string, lang string")
    counts = {}
    for r in language.count_grams(frame).collect():
        g, n = counts.setdefault(r["lang"], ([], []))
        g.append(r["gram"]), n.append(r["n"])
    model = language.Model({k: (np.array(g), np.array(n)) for k, (g, n) in counts.items()})
    column = pa.array([text(rng, 8, "de"), "q", "Xyz ß", "", None, text(rng, 3, "fr")])
    for at, rows, data, offsets in language.byte_chunks(column):
        bits = model.code_lengths(data, offsets)
    for t, row in zip(column.to_pylist(), bits):
        for lang, got in zip(model.languages, row):
            want = brute_bits([x.lower().encode() for x in own[lang]], (t or "").lower().encode())
            assert abs(got - want) <= 1e-3 * want, (t, lang)


def test_held_out_accuracy_and_awkward_rows(spark, tmp_path):
    rng = random.Random(13)
    rows = awkward(rng, 120) + [(500, "12345 !!! 678", "en", "a", None), (501, text(rng, 20, "fr"), None, "a", None), (None, text(rng, 20, "de"), "de", None, None)]
    sf = write(tmp_path, True, documents=rows)
    docs, got = read(sf, "documents"), rows_of(OP(spark, sf))
    assert len(got) == len(docs)
    lang = {d["doc_id"]: d["lang"] for d in docs}
    for r in got:
        assert r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["lang_pred"] for i in (120, 121, 122, 500)] == ["und"] * 4 and by_id[501]["lang_pred"] == "fr"
    out = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 120]
    assert len(out) > 20 and sum(out) == len(out)


def test_given_tables(spark):
    lang = {d["doc_id"]: d["lang"] for d in read(SF, "documents")}
    out = [r["lang_pred"] == lang[r["doc_id"]] for r in rows_of(OP(spark, SF)) if r["held_out"]]
    assert sum(out) >= 0.98 * len(out)


def test_nothing_to_learn_from(spark, tmp_path):
    assert rows_of(OP(spark, write(tmp_path, documents=[]))) == []
    got = rows_of(OP(spark, write(tmp_path, documents=[(1, "some text", None, None, None)])))
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]


def test_extra_columns_stay(spark, tmp_path):
    docs = spark.read.parquet(f"{write(tmp_path, True, documents=awkward(random.Random(14), 20))}/documents.parquet")
    told = language.identify(docs)
    assert set(docs.columns) - {"score", "lang_pred"} <= set(told.columns) and told.schema["score"].dataType.typeName() == "double"
    assert told.count() == docs.count()
