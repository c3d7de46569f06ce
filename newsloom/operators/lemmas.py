"""Lemmas of nouns by rule: suffixes are detached, and what is left counts if a lemma table knows it.

After Morphy of WordNet: a form with exceptions takes those; any other is tried as it stands and with each suffix of `RULES`
replaced, and if nothing is known, what was tried is detached again. Every round looks all candidates of all different
forms up in one join; the texts never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import lookup_join
from newsloom.session import released, stored

# The endings of English nouns and what takes their place.
RULES = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def detached(form: Column) -> Column:
    """What the rules make of a form, as an array; empty where none fits."""
    made = [F.when(F.endswith(form, F.lit(old)), F.concat(F.substr(form, F.lit(1), F.length(form) - len(old)), F.lit(new))) for old, new in RULES]
    return F.filter(F.array_distinct(F.array_compact(F.array(*made))), lambda c: c != "")


def noun_lexicon(forms: DataFrame, lemmas: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(form, lemma) of the different `forms` (form) whose lemma, a row of `lemmas` (lemma), is another word.

    Of several known candidates of a round the shortest counts, of equally short ones the first by name. A form of `exceptions` (form,
    lemma) is itself or one of its exceptions. Forms of which nothing is known keep their place, like nulls, and are not returned.
    """
    known = stored(lemmas.select(F.col("lemma").alias("candidate")).where(F.col("candidate").isNotNull()).distinct(), "lemmas")
    left = forms.select("form").where(F.col("form").isNotNull()).distinct()
    if exceptions is not None:
        special = stored(exceptions.where(F.col("form").isNotNull() & F.col("lemma").isNotNull()).groupBy("form").agg(F.collect_set("lemma").alias("special")), "exceptions")
        left = lookup_join(left, special, ["form"], ["form"])
    else:
        left = left.withColumn("special", F.lit(None).cast("array<string>"))
    # What a form may come from: itself and, but for exceptions, what the rules make of it.
    made = F.coalesce("special", detached(F.col("form")))
    tried = stored(left.select("form", F.col("special").isNotNull().alias("settled"), F.array_union(F.array("form"), made).alias("candidates"), made.alias("made")), "candidates")
    found = []
    while True:
        pairs = tried.select("form", F.explode("candidates").alias("candidate"))
        met = lookup_join(pairs, known, ["candidate"], ["form", "candidate"], "inner")
        best = F.min(F.struct(F.length("candidate").alias("length"), "candidate"))["candidate"]
        here = stored(met.groupBy("form").agg(best.alias("lemma")), "lemmas-found")
        found.append(here)
        again = F.array_distinct(F.flatten(F.transform("made", detached)))
        rest = lookup_join(tried.where("not settled"), here, ["form"], ["form"]).where(F.col("lemma").isNull())
        rest = rest.select("form", "settled", again.alias("made")).where(F.size("made") > 0).withColumn("candidates", F.col("made"))
        following = stored(rest.select("form", "settled", "candidates", "made"), "candidates")
        released(tried)
        tried = following
        if tried.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out.where("lemma <> form")
