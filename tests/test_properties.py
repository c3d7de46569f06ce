"""Random inputs against plain statements of the rules."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import ranking, tfidf

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
NEWSY = st.lists(
    st.lists(
        st.sampled_from(
            ["5%", "-5 %", "7 percent", "4.3 per  cent", "$5.2bn", "€3m", "£ 1,000", "12 million", "1999", "2031x", "march 14", "14 May",
             "q3", "Q9", "$tsla", "a6", "7b", "8.5x", "1,234.5", "42.", "__x", "é4", "<b>", "</b>", "https://a.test/1", "www.b.test", "word",
             "Read more: 1", "copyright © 2023", "\n", " ", "\t", ".", ",", "%", "+1", "a-4%", "９", "mañana"]
        ),
        max_size=14,
    ).map(lambda parts: " ".join(parts)),
    min_size=1,
    max_size=60,
)


def applied(spark, rows, fn):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, c string").coalesce(1)
    return [r[1] for r in df.select("i", fn(F.col("c"))).orderBy("i").collect()]


@FEW
@given(NEWSY)
def test_each_rule_reads_like_its_pattern_in_python(spark, rows):
    rows = [r.lower() for r in rows]
    for name, pattern, flags, replacement in text.FINANCE_RULES:
        python = re.compile(pattern, (re.I if "i" in flags else 0) | (re.M if "m" in flags else 0))
        want = [python.sub(replacement.replace("$1", r"\1"), r) for r in rows]
        assert applied(spark, rows, lambda c: text.finance_rule(c, name)) == want


@FEW
@given(NEWSY)
def test_guards_change_nothing(spark, rows):
    def unguarded(c):
        c = text.fold_and_lower(c)
        for rule in text.FINANCE_RULES:
            c = text.finance_rule(c, rule[0])
        return text.collapse_space(c)

    assert applied(spark, rows, text.normalize_finance) == [v or "" for v in applied(spark, rows, unguarded)]


@FEW
@given(NEWSY)
def test_no_number_is_left_on_its_own(spark, rows):
    for got in applied(spark, rows, text.normalize_finance):
        assert not re.search(r"(?:^|\s)\d+(?:\s|$)", got)
        assert got == got.strip() and "  " not in got


LINES = st.lists(st.lists(st.sampled_from(["a", "A", " b", "B ", "", "  ", "é", "É", "c\td"]), max_size=12).map("\n".join), min_size=1, max_size=60)


@FEW
@given(LINES)
def test_cleaned_lines(spark, rows):
    def cleaned(given):
        seen, kept = set(), []
        for line in given.split("\n"):
            line = line.strip()
            if line and line.lower() not in seen:
                seen.add(line.lower())
                kept.append(line)
        return "\n".join(kept) if given else None

    once = applied(spark, rows, text.light_clean)
    assert once == [cleaned(r) for r in rows]
    assert [t for t in applied(spark, once, text.light_clean)] == [t or None for t in once]


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None, ""]), st.integers(0, 5)), min_size=1, max_size=80))
def test_dedupe_keeps_the_first_of_each_key(spark, pairs):
    data = [(i, k, o) for i, (k, o) in enumerate(pairs)]
    df = spark.createDataFrame(data, "id int, k string, o int")
    got = {r.k: r.id for r in ranking.dedupe(df, ["k"], ["o", "id"]).collect()}
    assert got == {k: min((o, i) for i, kk, o in data if kk == k)[1] for k in {k for _, k, _ in data}}


@FEW
@given(st.lists(st.lists(st.sampled_from(["aa", "bb", "cc", "dd", "x"]), max_size=8).map(" ".join), min_size=3, max_size=30))
def test_vectors_have_length_one(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    model = tfidf.fit_tfidf(df, "id", "t", tfidf.TfidfConfig(min_df=1, max_df=1.0))
    norms = tfidf.transform_tfidf(model, df).groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)
    assert {r.id for r in norms} == {i for i, t in enumerate(texts) if re.search(r"\w\w", t)}


@FEW
@given(st.text(alphabet="ab \t\n\x0b\x1c\x85  　", max_size=20))
def test_white_space_is_that_of_python(spark, given):
    rows = [given, given + "a", "b" + given]
    assert applied(spark, rows, text.strip) == [r.strip() for r in rows]
    assert applied(spark, rows, text.word_count) == [len(r.split()) for r in rows]
    assert applied(spark, rows, text.is_blank) == [not r.strip() for r in rows]
    assert [a or [] for a in applied(spark, rows, text.tidy_lines)] == [[s.strip() for s in r.splitlines() if s.strip()] for r in rows]
