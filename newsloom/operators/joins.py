"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
NULL_SPLITS = 4096


def skew_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "left"
) -> DataFrame:
    """Equi-join a large `left`, whose keys may be hot, with a `right` of few rows per key.

    Both sides are shuffled by the keys and `part_of_key`. The latter is 0 but for rows of
    `left` without a key: they match nothing and are spread by a hash of `spread_by`
    (columns that tell rows apart). Partitions of hot keys are split by adaptive execution,
    in as many pieces as their size asks for; since no later step can rely on a
    partitioning by `part_of_key`, such a split never has to be given up for one.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    part = F.when(no_key, F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SPLITS))).otherwise(F.lit(0))
    # Always 0, but not a literal: the optimizer would turn that into a filter and drop the key.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    joined = left.withColumn("part_of_key", part.cast("int")).join(
        right.withColumn("part_of_key", zero.cast("int")), [*keys, "part_of_key"], how
    )
    return joined.drop("part_of_key")


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table stays within both bounds, measured over all its rows."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return seen["n"] <= max_rows and seen["size"] <= max_bytes


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "left"
) -> DataFrame:
    """Join with a stored lookup table: broadcast if it was measured to be small, else split."""
    if is_small(right):
        return left.join(F.broadcast(right), keys, how)
    return skew_join(left, right, keys, spread_by, how)
