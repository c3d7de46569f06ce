"""Decision lists: statistics against brute force, learning, awkward rows."""

import random
import re

from newsloom.llm import decision_list
from newsloom.llm.registry import QUERIES
from tests.llm.data import SF, awkward, read, rows_of, text, write

OP = QUERIES["op3_quality_rules"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = {x for x in windows if windows.count(x) > 1} if len(windows) < 500 else None
    if often is None:
        seen = {}
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        often = {x for x, n in seen.items() if n > 1}
    covered = {i + k for i, x in enumerate(windows) if x in often for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def check(docs, got):
    assert len(got) == len(docs)
    want = {d["doc_id"]: brute(d["text"]) for d in docs}
    for r in got:
        stats = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert stats == want[r["doc_id"]]
        assert r["base_failed"] == (stats[0] < 10 or 100 * stats[4] > 20 * stats[0])
        assert not (r["base_failed"] and r["kept"])


def junk(rng, n):
    return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text(rng, n).split())


def test_statistics_and_rules_on_awkward_rows(spark, tmp_path):
    rng = random.Random(4)
    docs = awkward(rng, 80) + [(1000 + i, junk(rng, 40), "en", "a", None) for i in range(60)]
    docs += [(2000 + i, " ".join(["again"] * 30 + text(rng, 5).split()), "en", "a", None) for i in range(5)]
    docs += [(3000, "a b c d e f g a b c d e x a b c d e", "en", "a", None), (3001, "x\nx\n\n \nx\ny", "en", "a", None), (3002, "r " * 9, "en", "a", None)]
    labels = [(d[0], int(d[0] < 1000 or d[0] >= 2000), 0) for d in docs] + [(1000, None, None), (None, 0, 0), (77777, 0, 0)]
    sf = write(tmp_path, True, documents=docs, labels=labels)
    got = rows_of(OP(spark, sf))
    check(read(sf, "documents"), got)
    by_id = {r["doc_id"]: r for r in got}
    assert not any(by_id[1000 + i]["kept"] for i in range(60))
    good = [by_id[i] for i in range(80) if not by_id[i]["base_failed"]]
    assert sum(r["kept"] for r in good) >= 0.95 * len(good)


def test_rules_follow_the_labels(spark):
    got, labels = rows_of(OP(spark, SF)), {r["doc_id"]: r["quality"] for r in read(SF, "labels")}
    check(read(SF, "documents"), got)
    right = [(r["kept"] or r["base_failed"]) == bool(labels[r["doc_id"]]) or r["base_failed"] for r in got if r["doc_id"] in labels]
    assert sum(right) >= 0.97 * len(right)


def test_without_labels_everything_is_kept(spark, tmp_path):
    docs = [(1, "a b c d e f g h i j k l", None, None, None), (2, None, None, None, None)]
    got = {r["doc_id"]: r for r in rows_of(OP(spark, write(tmp_path, documents=docs, labels=[])))}
    assert got[1]["kept"] and not got[2]["kept"] and got[2]["base_failed"]
    assert rows_of(OP(spark, write(tmp_path, documents=[], labels=[(1, 1, 1)]))) == []


def test_verdict_takes_the_first_rule(spark):
    c = decision_list.Condition
    rules = [[c("a", True, 2.0), c("b", False, 1.0)], [c("b", True, 5.0)]]
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 7.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(decision_list.verdict(rules)).collect()] == [1, 2, 0]
    assert decision_list.describe(rules)[0] == "a >= 2 and b < 1"
