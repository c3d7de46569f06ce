"""Lemmas of nouns against the rules said plainly."""

import random

from newsloom.operators import lemmas as lm


def plain(form, nouns, exceptions):
    pick = lambda cs: min((c for c in cs if c in nouns), key=lambda c: (len(c), c), default=None)
    if form in exceptions:
        return pick([form, *exceptions[form]]) or form
    made = [form]
    first = True
    while made:
        made = [m[: len(m) - len(old)] + new for m in made for old, new in lm.RULES if m.endswith(old)]
        if got := pick([form, *made] if first else made):
            return got
        first = False
    return form


def test_lexicon_equals_the_plain_rules(spark):
    rng = random.Random(3)
    endings = [o for o, _ in lm.RULES] + [n for _, n in lm.RULES] + ["", "sss", "xeses"]
    make = lambda: "".join(rng.choice("abxyz") for _ in range(rng.randint(0, 2))) + rng.choice(endings) + rng.choice(endings)
    forms = {make() for _ in range(900)} - {""}
    nouns = {make() for _ in range(250)} | {"glass", "axis", "wolf", "woman"}
    forms |= {"glasses", "axes", "wolves", "women", "classes", "s", "men"}
    exceptions = {f: {make(), make()} - {""} for f in rng.sample(sorted(forms), 40)} | {"axes": {"axis", "axe"}}
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    got = lm.noun_lexicon(
        frame([(f,) for f in forms] * 2 + [(None,)], "form string"), frame([(n,) for n in nouns if n] + [(None,)], "lemma string"),
        frame([(f, x) for f, xs in exceptions.items() for x in xs] + [(None, "a"), ("a", None)], "form string, lemma string"),
    )
    want = {f: plain(f, nouns, exceptions) for f in forms}
    assert {r["form"]: r["lemma"] for r in got.collect()} == {f: w for f, w in want.items() if f != w}
    assert want["wolves"] == "wolf" and want["women"] == "woman" and want["axes"] == "axis" and want["glasses"] == "glass"


def test_nothing_known(spark):
    one = spark.createDataFrame([("cats",)], "form string")
    assert lm.noun_lexicon(one, spark.createDataFrame([], "lemma string")).collect() == []
    assert lm.noun_lexicon(one.where("false"), spark.createDataFrame([("cat",)], "lemma string")).collect() == []
    assert [tuple(r) for r in lm.noun_lexicon(one, spark.createDataFrame([("cat",)], "lemma string")).collect()] == [("cats", "cat")]
