"""Toxicity by class-conditional Kneser-Ney models (operator 12).

Two models, of toxic and of ordinary documents, tell how likely a word is. A word is reached along a chain of
expressions: its first three, five and seven letters, then the whole word. On each link a class has its own
absolutely discounted counts (documents of the class with the expression, less one), and backs off to the link
before, as Kneser-Ney models do: the mass of the discounts, over both classes, times the probability of the
shorter expression, shared out by continuation counts, the number of different expressions that follow it in either class.
The backoff counts are shared, so a word that neither class knows is equally likely in both, and a rare one
takes after words that begin alike.

A toxic document is ordinary text with toxic expressions in it, so its model mixes both: a word's value is
log(1 - e + e toxic / ordinary). A document's value is the sum over all its words divided by their number plus
twenty, the difference of its length-normalised log-likelihoods under both models, shrunk where there is little to go by. Isotonic
regression on labelled documents that were not counted turns values into probabilities.

All labelled rows given are counted, so the model grows with them. Expressions whose value is that of the link
before (all that occur once in a class at most, and differences under `TOLERANCE`) are not kept. Up to `MAX_BROADCAST`
expressions are sent to every executor (12 bytes each) and the texts are scored in one pass; of more, the table stays
where it is and is joined with the different words of the texts, with the same result (`scored_by_join`).

Cases: null, empty and letterless texts have the value 0 and are scored like any other; null labels are left out and
repeated labels count by their mean (at least a half: 1); without labelled rows of both kinds every score is the share of
toxic labels (or 0.5); repeated rows score alike, and so do texts of equal value; texts of any length are read whole,
in pieces of half a megabyte or single texts; an empty table gives no rows; extra columns stay, those of the outputs' names are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import fold, unused
from newsloom.llm.language import byte_chunks
from newsloom.llm.registry import query, table
from newsloom.llm.shingles import BASE, mixed
from newsloom.operators.joins import lookup_join, skew_join
from newsloom.session import released, stored

#: Letters of the shorter expressions of a word.
LINKS = (3, 5, 7)
KINDS = len(LINKS) + 1
DISCOUNT = 1
#: Share of a toxic document's words that come from the toxic model.
MIXED = 0.01
SHRINK = 20
TOLERANCE = 0.002
MAX_BROADCAST = 1 << 23
ACCEPT = 0.7
STEPS = 512
#: Values of this size lie in the middle of the steps.
MIDDLE = 0.05
#: Of so many labelled documents one calibrates.
CALIBRATE = 5
HELD_COUNTS = 1 << 20
NODES = "node bigint, parent bigint, kind int, depth int, ordinary bigint, toxic bigint"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point its lower case if it is a letter or a mark, else 0; those from 2^16 on count as letters."""
    out = np.zeros((1 << 16) + 1, np.uint32)
    for code in range(1 << 16):
        c = chr(code)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            out[code] = ord(c.lower()[0])
    out[-1] = 1 << 16
    return out


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of texts that lie end to end as UTF-8, the texts' offsets among them)."""
    start = np.flatnonzero((data & 0xC0) != 0x80)
    n = np.clip(np.diff(np.append(start, len(data))), 1, 4)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    code = padded[start] & np.array([0, 0x7F, 0x1F, 0x0F, 0x07], np.uint32)[n]
    for more in range(1, 4):
        code = np.where(n > more, code << np.uint32(6) | padded[start + more] & np.uint32(0x3F), code)
    return np.where(n == 1, padded[start], code), np.searchsorted(start, offsets)


def word_links(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, keys of its expressions); a column a link, the whole word last, 0 where a word is too short."""
    code, begins = code_points(data, offsets)
    folded = letters()[np.minimum(code, 1 << 16)]
    letter = folded > 0
    edge = np.ones(len(code) + 1, bool)
    edge[1:-1] = letter[1:] != letter[:-1]
    edge[begins] = True
    start = np.flatnonzero(edge[:-1] & letter)
    if not len(start):
        return start, np.zeros((0, KINDS), np.int64)
    end = np.flatnonzero(edge[1:] & letter) + 1
    length = end - start
    place = np.arange(len(code)) - np.repeat(np.append(0, start), np.diff(np.concatenate([[0], start, [len(code)]])))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), BASE, np.uint64)]), dtype=np.uint64)
        # Letters beyond the table keep their code.
        own = np.where(folded == 1 << 16, code, folded).astype(np.uint64)
        value = np.where(letter, mixed(own + BASE), np.uint64(0)) * powers[place]
        upto = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
        keys = np.zeros((len(start), KINDS), np.uint64)
        for k, link in enumerate(LINKS):
            longer = length > link
            keys[longer, k] = mixed(upto[start[longer] + link] - upto[start[longer]] + np.uint64(k + 1))
        keys[:, -1] = mixed(upto[end] - upto[start] + np.uint64(KINDS))
    keys[keys == 0] = np.where(np.arange(KINDS) == KINDS - 1, 1, 0)[np.nonzero(keys == 0)[1]]
    return np.searchsorted(begins, start, side="right") - 1, keys.view(np.int64)


def nodes_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, node, parent, kind, depth) of all expressions of words given by their keys; the parent of the first is 0."""
    there = keys != 0
    depth = np.cumsum(there, 1)
    word, kind = np.nonzero(there)
    node, at = keys[word, kind], depth[word, kind]
    parent = np.where(at > 1, np.concatenate([[0], node[:-1]]), 0) if len(node) else node
    return word, node, parent, kind, at


def count_nodes(docs: DataFrame) -> DataFrame:
    """(node, parent, kind, depth, ordinary, toxic) over `docs` (text, toxic): documents of each class with the expression's words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            rows = np.concatenate(held)
            order = np.argsort(rows[:, 0], kind="stable")
            rows = rows[order]
            new = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            sums = np.add.reduceat(rows[:, 4:], new, 0)
            columns = [pa.array(rows[new, 0]), pa.array(rows[new, 1]), pa.array(rows[new, 2], pa.int32()), pa.array(rows[new, 3], pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])]
            return pa.RecordBatch.from_arrays(columns, ["node", "parent", "kind", "depth", "ordinary", "toxic"])

        for batch in batches:
            toxic = np.asarray(batch.column("toxic"))
            for at, _, data, offsets in byte_chunks(batch.column("text")):
                row, keys = word_links(data, offsets)
                # Each word of a document once.
                _, first = np.unique(mixed(keys[:, -1].view(np.uint64) + row.astype(np.uint64) * BASE), return_index=True)
                word, node, parent, kind, depth = nodes_of(keys[first])
                bad = toxic[at + row[first]][word] == 1
                held.append(np.stack([node, parent, kind, depth, ~bad, bad], 1).astype(np.int64))
                size += len(node)
                if size > HELD_COUNTS:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    parts = docs.select("text", "toxic").mapInArrow(count, NODES)
    same = [F.first(c).alias(c) for c in ("parent", "kind", "depth")]
    return parts.groupBy("node").agg(*same, F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def _values(counts: DataFrame) -> DataFrame:
    """(node, value) of the expressions that change a word's value; counts are read once a link."""
    own = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0))
    sums = {
        r["kind"]: r
        for r in counts.groupBy("kind").agg(
            F.sum(own("ordinary")).alias("ordinary"), F.sum(own("toxic")).alias("toxic"), F.sum(F.col("ordinary") + F.col("toxic")).alias("all")
        ).collect()
    }
    # What the discounts left to shorter expressions, over both classes.
    left = {k: 1 - (r["ordinary"] + r["toxic"]) / r["all"] for k, r in sums.items()}
    of = lambda values: F.element_at(F.array(*[F.lit(float(values.get(k, 1))) for k in range(KINDS)]), F.col("kind") + 1)
    follow = stored(counts.groupBy("parent").agg(F.count(F.lit(1)).alias("follow")), "continuations")
    at_root = (follow.where("parent = 0").first() or {"follow": 0})["follow"]

    def chance(c: str, before: Column) -> Column:
        discounted = own(c) / of({k: max(1, r[c]) for k, r in sums.items()})
        return (1 - of(left)) * discounted + of(left) * before / (F.col("follow") + 1)

    found, before, done = [], None, []
    for depth in range(1, KINDS + 1):
        here = counts.where(F.col("depth") == depth)
        if before is None:
            here = here.withColumns({"follow": F.lit(at_root), "p_ordinary": F.lit(1.0), "p_toxic": F.lit(1.0), "inherited": F.lit(0.0)})
        else:
            shorter = before.join(follow.withColumnRenamed("parent", "node"), "node").select(
                F.col("node").alias("parent"), "follow", F.col("q_ordinary").alias("p_ordinary"), F.col("q_toxic").alias("p_toxic"), F.col("known").alias("inherited")
            )
            here = skew_join(here, shorter, ["parent"], ["node"], "inner")
        q = here.withColumns({"q_ordinary": chance("ordinary", F.col("p_ordinary")), "q_toxic": chance("toxic", F.col("p_toxic"))})
        value = F.log(F.lit(1 - MIXED) + MIXED * F.col("q_toxic") / F.col("q_ordinary"))
        keep = F.abs(value - F.col("inherited")) > TOLERANCE
        q = q.withColumns({"known": F.when(keep, value).otherwise(F.col("inherited")), "kept": keep})
        before = stored(q.select("node", "q_ordinary", "q_toxic", "known", "kept"), "links")
        done.append(before)
        found.append(before.where("kept").select("node", F.col("known").cast("float").alias("value")))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    kept = stored(out, "expressions")
    for t in [follow, *done]:
        released(t)
    return kept


class Lookup:
    """Values of expressions, found by their keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The value of the longest known expression of each word."""
        out = np.zeros(len(keys))
        if len(self.keys):
            todo = np.arange(len(keys))
            for kind in range(KINDS - 1, -1, -1):
                key = keys[todo, kind]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                met = self.keys[at] == key
                out[todo[met]] = self.values[at[met]]
                todo = todo[~met]
        return out

    def texts(self, column: pa.Array) -> np.ndarray:
        """The value of each text."""
        out = np.zeros(len(column))
        for at, rows, data, offsets in byte_chunks(column):
            row, keys = word_links(data, offsets)
            if len(row):
                out[at : at + rows] = np.bincount(row, self(keys), rows) / (np.bincount(row, minlength=rows) + SHRINK)
        return out


class Calibration:
    """Probabilities of values: straight lines between the middles of pools."""

    def __init__(self, knots: np.ndarray, chances: np.ndarray) -> None:
        self.knots, self.chances = knots, chances

    def __call__(self, value: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(squeezed(value), self.knots, self.chances), 0.0, 1.0)


def squeezed(value: np.ndarray) -> np.ndarray:
    return value / (np.abs(value) + MIDDLE)


def pooled(seen: np.ndarray, toxic: np.ndarray) -> Calibration:
    """The rising probabilities closest to toxic / seen of equal steps of squeezed values."""
    pools: list[list[float]] = []
    middle = (np.arange(STEPS) + 0.5) * 2 / STEPS - 1
    for at in np.flatnonzero(seen):
        pools.append([toxic[at], seen[at], middle[at] * seen[at]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools).reshape(-1, 3)
    return Calibration(p[:, 2] / p[:, 1], p[:, 0] / p[:, 1])


class Model:
    def __init__(self, expressions: DataFrame | None, calibration: Calibration, max_broadcast: int = MAX_BROADCAST) -> None:
        self.expressions, self.calibration = expressions, calibration
        self.lookup = None
        if expressions is not None and expressions.count() <= max_broadcast:
            known = expressions.toArrow()
            self.lookup = Lookup(np.asarray(known.column("node")), np.asarray(known.column("value")))


def measured(docs: DataFrame, lookup: Lookup, name: str, text: str = "text") -> DataFrame:
    """The other columns of `docs` with the value of the text in column `name`."""
    shared = docs.sparkSession.sparkContext.broadcast(lookup)
    others = [f for f in docs.schema.fields if f.name not in (text, name)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in others], pa.array(shared.value.texts(batch.column(text)))], [*[f.name for f in others], name])

    return docs.select(*[f.name for f in others], text).mapInArrow(measure, T.StructType([*others, T.StructField(name, T.DoubleType())]))


def digests(text: Column) -> list[Column]:
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(F.lit(s), whole).alias(f"digest_{s}_") for s in (1, 2)]


def measured_by_join(docs: DataFrame, expressions: DataFrame, name: str, text: str = "text") -> DataFrame:
    """As `measured`, with a table of expressions of any size: the different words of the texts look theirs up."""
    links = [f"link_{k}" for k in range(KINDS)]
    both = ["digest_1_", "digest_2_"]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, data, offsets in byte_chunks(batch.column("text")):
                row, keys = word_links(data, offsets)
                if not len(row):
                    continue
                _, first, n = np.unique(mixed(keys[:, -1].view(np.uint64) + row.astype(np.uint64) * BASE), return_index=True, return_counts=True)
                of = pa.array(at + row[first])
                columns = [pa.array(keys[first, k], mask=keys[first, k] == 0) for k in range(KINDS)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(of) for c in both], *columns, pa.array(n)], [*both, *links, "n"])

    schema = ", ".join(f"{c} bigint" for c in [*both, *links, "n"])
    # Copies of a text count once.
    counted = docs.select(*digests(F.col(text)), F.col(text).alias("text")).mapInArrow(words, schema).groupBy(*both, *links).agg(F.max("n").alias("n"))
    counted = stored(counted, "words-of-texts")
    found = counted.select(*links).distinct()
    for k, link in enumerate(links):
        found = skew_join(found, expressions.select(F.col("node").alias(link), F.col("value").alias(f"value_{k}")), [link], links, "left")
    deepest = F.coalesce(*[F.col(f"value_{k}") for k in range(KINDS - 1, -1, -1)], F.lit(0.0)).cast("double").alias("value")
    priced = skew_join(counted.select(*both, links[-1], "n"), found.select(links[-1], deepest), [links[-1]], both, "inner")
    sums = priced.groupBy(*both).agg((F.sum(F.col("n") * F.col("value")) / (F.sum("n") + SHRINK)).alias("of_text_"))
    keyed = docs.withColumns(dict(zip(both, digests(F.col(text)))))
    return keyed.join(sums, both, "left").withColumn(name, F.coalesce("of_text_", F.lit(0.0))).drop(*both, "of_text_", text)


def _value_of(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    if model.lookup is not None:
        return measured(docs, model.lookup, name, text)
    return measured_by_join(docs, model.expressions, name, text)


def learn(docs: DataFrame, labels: DataFrame, max_broadcast: int = MAX_BROADCAST) -> Model:
    """Learn from all texts of `docs` (doc_id, text) that `labels` (doc_id, toxic) names; leave held-out labels out before."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    # Texts stay where they are unless the labels are too many to send round.
    joined = lookup_join(docs.select("doc_id", "text"), stored(known, "labels"), ["doc_id"], ["doc_id"], "inner")
    rows = joined.select("text", "toxic", (F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(CALIBRATE)) == 0).alias("apart"))
    rows = stored(rows, "labelled-texts")
    seen = {(r["apart"], r["toxic"]): r["n"] for r in rows.groupBy("apart", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = (seen.get((True, c), 0) + seen.get((False, c), 0) for c in (0, 1))
    if not good or not bad:
        return Model(None, Calibration(np.zeros(1), np.array([0.0 if good else 1.0 if bad else 0.5])))
    # Few rows teach and calibrate alike.
    both = [all(seen.get((apart, c), 0) for c in (0, 1)) for apart in (True, False)]
    counts = stored(count_nodes(rows.where("not apart") if all(both) else rows), "expression-counts")
    model = Model(_values(counts), Calibration(np.zeros(1), np.zeros(1)), max_broadcast)
    released(counts)
    told = _value_of(rows.where("apart") if all(both) else rows, model, "value")
    squeezed_ = F.col("value") / (F.abs("value") + MIDDLE)
    step = F.least(F.lit(STEPS - 1), F.floor((squeezed_ + 1) * (STEPS / 2))).cast("int").alias("step")
    seen_, toxic_ = np.zeros(STEPS), np.zeros(STEPS)
    for r in told.groupBy(step).agg(F.count(F.lit(1)).alias("seen"), F.sum("toxic").alias("toxic")).collect():
        seen_[r["step"]], toxic_[r["step"]] = r["seen"], r["toxic"]
    model.calibration = pooled(seen_, toxic_)
    released(rows)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without its text, with `score` and `predicted`."""
    name = unused(docs, "value_of_text")
    kept = docs.drop("score", "predicted")
    if model.expressions is None:
        told = kept.drop(text).withColumn(name, F.lit(0.0))
    else:
        told = _value_of(kept, model, name, text)
    knots, chances = model.calibration.knots, model.calibration.chances
    u = F.col(name) / (F.abs(name) + MIDDLE)
    lines = F.lit(float(chances[-1]))
    for at in range(len(knots) - 1, 0, -1):
        a, b, low, high = float(knots[at - 1]), float(knots[at]), float(chances[at - 1]), float(chances[at])
        lines = F.when(u < b, low + (high - low) * (u - a) / (b - a)).otherwise(lines)
    lines = F.when(u <= float(knots[0]), F.lit(float(chances[0]))).otherwise(lines)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), lines))
    return told.withColumn("score", score).withColumn("predicted", (F.col("score") >= ACCEPT).cast("int")).drop(name)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(fold("doc_id", 3) != 1))
    told = scored(docs.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "score", "predicted")
