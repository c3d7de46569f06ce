"""Mixing sources to target weights by hash-threshold histograms (operator 9).

Every document has a fixed hash. Of each source the mix takes all documents a whole number
of times, and once more those with a hash below the source's threshold. A threshold is found
from sums of words by (source, hash bucket): the bucket in which the budget ends is cut in
finer buckets, and only it, until the hash has no more bits. Nothing is sorted by hash, and
a source's size does not matter: its rows are summed on the map side. Thresholds nest: a
larger budget takes all documents of a smaller one.

Cases: a text of any length counts whole; rows on the last hash of a budget are taken together if that is nearer to the target; a null or blank text has no words and is taken 0 words of; a null source is a source of its
own, last in order; rows that agree in id and text share a hash and are taken alike; an empty table
gives an empty result; extra columns stay and may have any name, but `copies` is replaced. One row
per source meets in one task (ordering and resharing), never one per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.common import WORD, key_of, kept_row, opened
from newsloom.llm.registry import query, table
from newsloom.operators.joins import lookup_join
from newsloom.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
LEVELS = 4
BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """LEVELS * BITS bits that stay the same whenever the row does."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(20_11), doc_id, text), 64 - LEVELS * BITS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source_key, source_size, target) of a table of (source, source_key, size).

    Weights repeat over the sources by code point, null last. Targets share `share` of all
    sizes by weight; none is above `most` times its source's size, and what is cut goes to
    the others by weight: all share one level, target = min(most * size, weight * level).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    by_limit = Window.orderBy("full_at", "source_key")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    level = (share * F.sum("source_size").over(everywhere) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    per_source = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    leveled = (
        per_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int") + 1))
        .withColumn("full_at", most * F.col("source_size") / F.col("weight"))
        .withColumn("level_here", level)
        # The first source that its level does not fill fixes the level of all after it.
        .withColumn("common", F.min(F.when(F.col("level_here") <= F.col("full_at"), F.struct("full_at", "source_key", "level_here"))).over(everywhere))
    )
    target = F.least(most * F.col("source_size"), F.col("weight") * F.coalesce(F.col("common.level_here"), F.lit(float("inf"))))
    return leveled.select("source_key", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, levels: int = LEVELS, bits: int = BITS) -> DataFrame:
    """targets with `whole` (copies of every document) and `below` (hashes under it: one more)."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = stored(
        targets.withColumn("whole", whole.cast("int"))
        .withColumn("left_over", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long")),
        "mix-targets",
    )
    for level in range(1, levels + 1):
        below = bits * (levels - level)
        inside = lookup_join(sizes.select("source_key", "size", "hash"), state.select("source_key", "prefix"), ["source_key"], ["hash"], "inner")
        counted = (
            inside.withColumn("bucket", F.shiftrightunsigned("hash", below))
            .where(F.shiftrightunsigned("bucket", bits) == F.col("prefix"))
            .groupBy("source_key", "bucket")
            .agg(F.sum("size").alias("in_bucket"))
        )
        upto = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = (
            counted.withColumn("upto", F.sum("in_bucket").over(upto))
            .join(state.select("source_key", "left_over"), "source_key")
            .where(F.col("upto") > F.col("left_over"))
            .groupBy("source_key")
            .agg(F.min(F.struct("bucket", "upto", "in_bucket")).alias("end"))
        )
        # Where the budget reaches beyond all buckets, the last possible bucket ends it.
        last = F.shiftleft(F.col("prefix"), bits) + F.lit((1 << bits) - 1)
        state = stored(
            state.join(ends, "source_key", "left").select(
                "source_key", "source_size", "target", "whole",
                F.coalesce(F.col("end.bucket"), last).alias("prefix"),
                F.coalesce(F.col("left_over") - (F.col("end.upto") - F.col("end.in_bucket")), F.lit(float("inf"))).alias("left_over"),
                F.col("end.in_bucket").alias("in_bucket"),
            ),
            "mix-level",
        )
    # What shares the last hash is taken if that comes nearer to the target.
    takes = F.col("in_bucket").isNull() | (F.col("in_bucket") <= 2 * F.col("left_over"))
    return state.select("source_key", "source_size", "target", "whole", (F.col("prefix") + takes.cast("long")).alias("below"))


def copies_of(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` (source_key, hash, ...) with the plan's columns and `copies`."""
    joined = lookup_join(rows, plan, ["source_key"], ["hash"], "inner")
    return joined.withColumn("copies", F.col("whole") + (F.col("hash") < F.col("below")).cast("int"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", **settings) -> DataFrame:
    """`docs` with `copies`: how often the mix takes each document."""
    keyed = kept_row(docs, source_key=key_of(F.col(source)), source=F.col(source), size=n_words(F.col(text)), hash=row_hash(F.col(doc_id), F.col(text)))
    sizes = stored(keyed.drop("row"), "mix-sizes")
    plan = stored(thresholds(sizes, source_targets(sizes, **settings)), "mix-plan")
    return opened(copies_of(keyed.drop("source", "size"), plan), "copies")


@query("op9_mix_sources")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    source, text = F.col("source"), F.col("text")
    sizes = stored(
        docs.select("doc_id", "source", key_of(source).alias("source_key"), n_words(text).alias("size"), row_hash(F.col("doc_id"), text).alias("hash")),
        "mix-sizes",
    )
    plan = stored(thresholds(sizes, source_targets(sizes)), "mix-plan")
    mixed = copies_of(sizes, plan)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")
