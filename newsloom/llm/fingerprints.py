"""Order-independent, incremental document fingerprints (operator 7).

A fingerprint is a sum: each paragraph (a line of the text) is hashed to a wide vector, and the
vectors are added modulo powers of two. Texts of the same paragraphs in any order agree; inserting
or deleting a paragraph adds or subtracts its vector (`plus`, `minus`) without reading the rest.

The vector has two parts. `exact`: 8 numbers of 32 bits, hashes of the paragraph under 4 seeds, summed
modulo 2^32, for equality. `lanes`: for each of 120 hash bits the number of the paragraph's different windows that have it.
A window is `WINDOW` neighbouring words of a paragraph; of scripts without blanks every letter is a
word, and longer words count as pieces of `PIECE` letters. Every counter is a sum of random signs, so the
cosine of two texts' counters estimates the cosine of their counts of windows. `n_windows` is the number of
windows. A window that a paragraph repeats counts once there, or one phrase said often would outweigh the text.

Three counters are added up as fields of one number, over slices of a text that hold fewer windows than a field can count
(`PARAGRAPHS_IN_SLICE`, `WINDOWS_IN_SLICE`); then they are opened and each is a sum of its own.

Cases: texts are read whole, however long; neighbours of equal ids follow the order of their texts; a null text is empty and an empty text is one empty paragraph; repeated paragraphs count as
often as they occur; repeated ids are told apart by order of text; one document is its own next; an
empty table gives an empty result; a paragraph of fewer words, or none, is one window. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import let
from newsloom.llm.common import parallelism
from newsloom.llm.registry import query, table

SEEDS = (1, 2, 3, 4)
LANE_SEEDS = (11, 12)
#: Bits used of each seed's hash: from each of three fields of 21 bits the lowest 20.
FIELD, FIELDS, FIELD_BITS = 21, 3, 20
LANE_BITS = FIELDS * FIELD_BITS
ONES = sum(1 << FIELD * f for f in range(FIELDS))
#: Fields hold the sums of at most this many paragraphs, and of as many windows of each: 2^20 in all.
PARAGRAPHS_IN_SLICE, WINDOWS_IN_SLICE = 1 << 9, 1 << 11
WINDOW = 3
PIECE = 16
#: A letter of a script written without blanks, or up to PIECE other letters.
WORD = (
    "[\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}\\p{IsTibetan}]"
    "|[^\\s\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}\\p{IsTibetan}]{1,%d}" % PIECE
)
#: Scripts without blanks have no letter before this code point.
BLANKS_UPTO = "[^\\x00-\\u0dff]"
LOW = (1 << 32) - 1
EXACT = [f"e{i}" for i in range(2 * len(SEEDS))]
LANES = [f"l{i}" for i in range(LANE_BITS * len(LANE_SEEDS))]


def words_of(text: Column) -> Column:
    plain = F.regexp_extract_all(text, F.lit("\\S{1,%d}" % PIECE), F.lit(0))
    return F.when(F.regexp_like(text, F.lit(BLANKS_UPTO)), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).otherwise(plain)


def windows_of(text: Column) -> Column:
    """The different hashes of the windows of a paragraph."""

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(h) - WINDOW, F.lit(0)))
        return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    return let(words_of(text), lambda words: let(F.transform(words, lambda w: F.xxhash64(w)), windows))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, exact, lanes, n_windows) per key; rows with the same keys add up."""
    paragraphs = texts.select(*keys, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("at", "paragraph"))
    windows = paragraphs.select(
        *keys, F.floor(F.col("at") / PARAGRAPHS_IN_SLICE).alias("slice"),
        *[F.xxhash64(F.lit(s), "paragraph").alias(f"p{s}") for s in SEEDS],
        F.posexplode(windows_of(F.col("paragraph"))).alias("place", "window"),
    )
    first = lambda s: F.when(F.col("place") == 0, F.col(f"p{s}")).otherwise(F.lit(0))
    hashed = windows.select(
        *keys, "slice", F.floor(F.col("place") / WINDOWS_IN_SLICE).alias("part"),
        *[first(s).alias(f"p{s}") for s in SEEDS], *[F.xxhash64(F.lit(s), "window").alias(f"s{s}") for s in LANE_SEEDS],
    )
    exact = [c for s in SEEDS for c in (F.col(f"p{s}").bitwiseAND(LOW), F.shiftrightunsigned(f"p{s}", 32))]
    packed = {f"f{s}_{j}": F.shiftrightunsigned(f"s{s}", j).bitwiseAND(ONES) for s in LANE_SEEDS for j in range(FIELD_BITS)}
    sliced = hashed.groupBy(*keys, "slice", "part").agg(
        *[F.sum(c).alias(n) for c, n in zip(exact, EXACT)], *[F.sum(c).alias(n) for n, c in packed.items()], F.count(F.lit(1)).alias("n")
    )
    field = lambda n, f: F.shiftrightunsigned(n, FIELD * f).bitwiseAND((1 << FIELD) - 1)
    opened = [field(f"f{s}_{j}", f) for s in LANE_SEEDS for f in range(FIELDS) for j in range(FIELD_BITS)]
    summed = sliced.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in EXACT], *[F.sum(c).alias(n) for c, n in zip(opened, LANES)], F.sum("n").alias("n_windows")
    )
    return summed.select(*keys, F.array(*[F.col(n).bitwiseAND(LOW) for n in EXACT]).alias("exact"), F.array(*LANES).alias("lanes"), "n_windows")


def plus(a: Column, b: Column) -> Column:
    """The fingerprint (struct of exact, lanes, n_windows) of two texts' paragraphs together."""
    return _combined(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of `a` after deleting the paragraphs of `b`."""
    return _combined(a, b, -1)


def _combined(a: Column, b: Column, sign: int) -> Column:
    both = lambda x, y: x + y * F.lit(sign)
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: both(x, y).bitwiseAND(LOW)).alias("exact"),
        F.zip_with(a["lanes"], b["lanes"], both).alias("lanes"),
        both(a["n_windows"], b["n_windows"]).alias("n_windows"),
    )


def as_text(exact: Column, lanes: Column, n_windows: Column) -> Column:
    """The fingerprint as one string: the exact part in fixed width, then the counters."""
    return F.concat_ws(
        ".",
        F.array_join(F.transform(exact, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""),
        F.lower(F.hex(n_windows)),
        F.array_join(F.transform(lanes, lambda x: F.lower(F.hex(x))), "."),
    )


def signed(lanes: Column, n_windows: Column) -> Column:
    """The counters as sums of signs."""
    return F.transform(lanes, lambda x: (2 * x - n_windows).cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(same: Column, product: Column, norms: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the counters, not under 0."""
    return F.when(same, F.lit(1.0)).when(norms <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), product / F.sqrt(norms))))


def bucket_of(key: Column, cuts: list) -> Column:
    """How many of the sorted `cuts` are at most `key`, by steps in coarse and then fine cuts."""
    if not cuts:
        return F.lit(0)
    width = max(1, round(len(cuts) ** 0.5))
    fine = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    passed = lambda edges: F.aggregate(edges, F.lit(0), lambda n, e: n + F.coalesce(key >= e, F.lit(False)).cast("int"))
    group = passed(F.array(*[F.lit(g[0]) for g in fine]))
    inner = F.element_at(F.array(*[F.array(*[F.lit(c) for c in g]) for g in fine]), F.greatest(group, F.lit(1)))
    return F.greatest(group - 1, F.lit(0)) * width + passed(inner)


def with_next(docs: DataFrame, per_task: int = 4) -> DataFrame:
    """(bucket, seq, own, doc_id, text, next_text) in ascending doc_id; the last one's next is the first.

    Documents are dealt to buckets of neighbouring ids. The first of each bucket is also put
    after the last of the bucket before it (`own` is false there), so that one shuffle serves all.
    """
    n = max(2, per_task * parallelism(docs))
    key = F.col("doc_id")
    cuts = docs.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 100 * n).alias("cuts")).first()["cuts"] or []
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bucket_of(key, sorted(set(cuts))).alias("bucket"))
    # The first id of each bucket; there are at most n of them.
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id"))["doc_id"]
    firsts = {r["bucket"]: r["first"] for r in placed.groupBy("bucket").agg(least.alias("first")).collect()}
    used = sorted(firsts) or [0]
    at = {b: i for i, b in enumerate(used)}
    first = F.array(*[F.lit(firsts.get(b)).cast("bigint") for b in range(used[-1] + 1)])
    earlier = F.array(*[F.lit(used[at[b] - 1] if b in at else None).cast("int") for b in range(used[-1] + 1)])
    begins = F.col("doc_id").eqNullSafe(F.element_at(first, F.col("bucket") + 1))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(True).alias("own"))
    lent = F.struct(F.element_at(earlier, F.col("bucket") + 1).alias("bucket"), F.lit(False).alias("own"))
    dealt = placed.select("doc_id", "text", F.inline(F.when(begins, F.array(own, lent)).otherwise(F.array(own))))
    order = Window.partitionBy("bucket").orderBy(F.col("own").desc(), "doc_id", "text")
    return dealt.withColumn("seq", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    both = docs.withColumn("edited", F.when(F.col("own"), edited)).select(
        "bucket", "seq", "own", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.filter(F.array("text", "edited"), lambda t: t.isNotNull())).alias("which", "text"),
    )
    prints = fingerprints(both, ["bucket", "seq", "which", "own", "doc_id", "n_chars", "edited_sha256"])
    made = prints.withColumn("vector", signed(F.col("lanes"), F.col("n_windows"))).select(
        "bucket", "seq", "which", "own", "doc_id", "n_chars", "edited_sha256", "vector",
        as_text(F.col("exact"), F.col("lanes"), F.col("n_windows")).alias("fingerprint"),
        dot(F.col("vector"), F.col("vector")).alias("norm"),
    )
    # Behind a document's print come that of its edited text and that of the next document.
    order = Window.partitionBy("bucket").orderBy("seq", "which")
    mine = F.struct("fingerprint", "vector", "norm")
    beside = made.withColumn("edited_", F.lead(mine, 1).over(order)).withColumn("next_", F.lead(mine, 2).over(order)).where("own and which = 0")
    near = lambda o: likeness(F.col("fingerprint") == F.col(f"{o}.fingerprint"), dot(F.col("vector"), F.col(f"{o}.vector")), F.col("norm") * F.col(f"{o}.norm"))
    return beside.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", F.col("edited_.fingerprint").alias("edited_fingerprint"),
        near("edited_").alias("near_edited"), near("next_").alias("near_next"),
    )
