"""Quality rules learned as a decision list (operator 3).

Statistics of whole texts are column expressions. Rules are learned from labelled rows by
sequential covering: a rule grows one threshold condition at a time by information gain, loses
its last conditions again where that serves the rows held back for pruning, and is kept while
it is precise on those; the rows it covers leave, and the next rule is learned. Every step
reads one small table, the counts of labels by (statistic, threshold interval), which Spark
sums over all labelled rows. The list becomes one ordered `CASE WHEN` over the statistics.

Cases: a text of any length is measured whole, inside its row; documents of equal statistics get one verdict; a value on a threshold counts
as above it; at most 12 rules of 3 conditions are learned (arguments of `learn`); null text has no words; a text without words has all ratios 0; labels that are null are
left out, and repeated labels of a document count by their mean (at least a half: good); documents
that occur twice are learned from twice; without labelled rows of both kinds the list is empty and
everything is kept; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.common import GAP_RUN, GAPS
from newsloom.llm.registry import query, table
from newsloom.session import stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("n_words", "mean_chars", "symbols_per_word", "repeated_lines", "repeated_words", "distinct_words", "capitals", "marks", "digits")


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text, with counts and ratios of the whole text."""
    blank = F.translate("text_", GAPS, "")
    # White space at the ends would give empty words.
    inner = F.btrim("text_", F.lit(GAPS))
    others = [c for c in docs.columns if c != text]
    base = docs.select(*others, F.coalesce(text, F.lit("")).alias("text_")).select(
        *others,
        "text_",
        F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP_RUN)).alias("words_"),
        F.filter(F.split("text_", "\n"), lambda line: F.translate(line, GAPS, "") != "").alias("lines_"),
        blank.alias("blank_"),
    )
    w = "words_"
    hashes = F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))
    )
    counted = base.select(
        *others,
        F.size(w).cast("long").alias("n_words"),
        F.length("blank_").cast("long").alias("word_chars"),
        (F.length("blank_") - F.length(F.translate("blank_", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.size("lines_").alias("n_lines_"),
        F.size(F.array_distinct(w)).alias("n_distinct_"),
        F.regexp_count("blank_", F.lit("\\p{Lu}")).alias("n_capitals_"),
        F.regexp_count("blank_", F.lit("[\\p{P}\\p{S}]")).alias("n_marks_"),
        F.regexp_count("blank_", F.lit("\\p{Nd}")).alias("n_digits_"),
        hashes.alias("hashes_"),
    )
    # Only texts in which some window occurs twice are sorted.
    sorted_ = F.when(F.size(F.array_distinct("hashes_")) < F.size("hashes_"), F.sort_array(F.transform("hashes_", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    placed = counted.withColumn("sorted_", sorted_)
    same = lambda x, y: x["h"] == y["h"]
    starts = F.sort_array(
        F.transform(
            F.filter("sorted_", lambda x, i: F.coalesce(same(x, F.get("sorted_", i - 1)), F.lit(False)) | F.coalesce(same(x, F.get("sorted_", i + 1)), F.lit(False))),
            lambda x: x["i"],
        )
    )
    covered = F.aggregate(
        F.transform("starts_", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts_", k + 1) - s, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x
    )
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return (
        placed.withColumn("starts_", starts)
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .select(
            *others, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            per("word_chars", "n_words").alias("mean_chars"),
            per("n_symbols", "n_words").alias("symbols_per_word"),
            per("n_dup_lines", "n_lines_").alias("repeated_lines"),
            per("n_repeat_words", "n_words").alias("repeated_words"),
            per("n_distinct_", "n_words").alias("distinct_words"),
            per("n_capitals_", "word_chars").alias("capitals"),
            per("n_marks_", "word_chars").alias("marks"),
            per("n_digits_", "word_chars").alias("digits"),
        )
    )


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """`stats` with `good` (boolean) where labels tell it."""
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    return stats.join(known, "doc_id")


def _gain(bad: int, good: int, before: tuple[int, int]) -> float:
    """Information a condition adds about the bad rows it still covers."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(before[0] / sum(before)))


def learn(rows: DataFrame, features: tuple[str, ...] = FEATURES, cuts: int = 16, longest: int = 3, most_rules: int = 12, precision: float = 0.95, least: int = 3) -> list[list[Condition]]:
    """Conjunctions that mark bad documents, in order, from `rows` of features and `good`.

    `cuts` candidate thresholds per feature and label are quantiles of all rows; a third of the rows, by
    hash of their statistics, is held back for pruning, unless fewer than ten times `least` rows are bad. A rule
    needs `least` bad rows and the given precision.
    """
    spread = rows.groupBy("good").agg(F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(f, [(k + 0.5) / cuts for k in range(cuts)], 2000).alias(f) for f in features]).collect()
    if len(spread) < 2:
        return []
    edges = {f: sorted({float(x) for r in spread for x in r[f]} | {math.nextafter(float(x), math.inf) for r in spread for x in r[f]}) for f in features}
    interval = lambda f: F.aggregate(F.array(*[F.lit(e) for e in edges[f]]), F.lit(0), lambda n, e: n + (F.col(f) >= e).cast("int"))
    few = min(r["rows"] for r in spread if not r["good"]) < 10 * least
    held = F.pmod(F.xxhash64(*features), F.lit(3)) == 0
    left = stored(rows.select("good", held.alias("held"), *[interval(f).alias(f) for f in features]), "rules-rows")

    def fits(rule: list[tuple[str, bool, int]]) -> Column:
        """`rule` as a condition on intervals."""
        out = F.lit(True)
        for f, at_least, k in rule:
            out = out & (F.col(f) > k if at_least else F.col(f) <= k)
        return out

    def count(rows: DataFrame, rule: list) -> tuple[int, int]:
        got = rows.where(fits(rule)).agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("good")).first()
        return got["bad"], got["good"]

    found: list[list[tuple[str, bool, int]]] = []
    while len(found) < most_rules:
        grow, prune = (left, left) if few else (left.where(~F.col("held")), left.where("held"))
        rule: list[tuple[str, bool, int]] = []
        before = count(grow, rule)
        while len(rule) < longest and before[0] >= least and before[1]:
            by_interval = (
                grow.where(fits(rule))
                .select("good", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("k")) for i, f in enumerate(features)])).alias("x"))
                .groupBy("x.f", "x.k")
                .agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("good"))
                .collect()
            )
            best, gained, covers = None, 1e-9, before
            for i, f in enumerate(features):
                counts = {r["k"]: (r["bad"], r["good"]) for r in by_interval if r["f"] == i}
                low = [0, 0]
                for k in range(len(edges[f])):
                    low = [low[j] + counts.get(k, (0, 0))[j] for j in (0, 1)]
                    for at_least, c in ((False, tuple(low)), (True, tuple(before[j] - low[j] for j in (0, 1)))):
                        if c[0] >= least and (g := _gain(*c, before)) > gained:
                            best, gained, covers = (f, at_least, k), g, c
            if best is None:
                break
            rule.append(best)
            before = covers
        if not rule:
            break
        worth = lambda c: (c[0] - c[1]) / max(1, sum(c))
        shorter = [(worth(count(prune, rule[:n])), -n, n) for n in range(1, len(rule) + 1)]
        rule = rule[: max(shorter)[2]]
        bad, good = count(left, rule)
        if bad < least or bad < precision * (bad + good):
            break
        found.append(rule)
        left = left.where(~fits(rule))
    return _between([[Condition(f, at_least, edges[f][k]) for f, at_least, k in rule] for rule in found], rows)


def _between(rules: list[list[Condition]], rows: DataFrame) -> list[list[Condition]]:
    """The rules with each threshold halfway between the nearest values of `rows` on either side, which decides alike."""
    conditions = [c for rule in rules for c in rule]
    if not conditions:
        return rules
    sides = [x for c in conditions for x in (F.max(F.when(F.col(c.feature) < c.threshold, F.col(c.feature))), F.min(F.when(F.col(c.feature) >= c.threshold, F.col(c.feature))))]
    seen = rows.agg(*[s.alias(f"c{i}") for i, s in enumerate(sides)]).first()
    moved = {}
    for i, c in enumerate(conditions):
        below, above = seen[2 * i], seen[2 * i + 1]
        if below is not None and above is not None and below < (middle := (float(below) + float(above)) / 2) <= above:
            moved[c] = Condition(c.feature, c.at_least, middle)
    return [[moved.get(c, c) for c in rule] for rule in rules]


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that holds (from 1), or 0: the document is kept."""
    out = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(number)).otherwise(out)
    return out


def describe(rules: list[list[Condition]]) -> list[str]:
    return [" and ".join(f"{c.feature} {'>=' if c.at_least else '<'} {c.threshold:.6g}" for c in rule) for rule in rules]


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of `docs` (doc_id, text) with `rule`, the rule that rejects a document (0: none)."""
    stats = stored(text_statistics(docs.select("doc_id", "text")), "rules-stats")
    return stats.withColumn("rule", verdict(learn(labelled(stats, labels))))


@query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("rule") == 0)).alias("kept"), "rule",
    )
