"""Keep-first, top-n and numbering, each with an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stored

# Up to this n Spark cuts each group to n rows before the shuffle (window group limit).
NATIVE_LIMIT = 1000
SPLITS = 64


def _as_columns(order_by: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def top_n_per_group(df: DataFrame, group: list, order_by: list, n: int) -> DataFrame:
    """The first `n` rows of each group; a hot group is cut in parts before it meets."""
    group, order = _as_columns(group), _as_columns(order_by)
    if n > NATIVE_LIMIT:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(SPLITS))
        parts = Window.partitionBy(*group, part).orderBy(*order)
        df = df.withColumn("rank_in_part", F.row_number().over(parts))
        df = df.where(F.col("rank_in_part") <= n).drop("rank_in_part")
    ranked = df.withColumn("rank_in_group", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank_in_group") <= n).drop("rank_in_group")


def dedupe(df: DataFrame, keys: list[str], order_by: list, nulls: str = "collapse") -> DataFrame:
    """Keep the first row of each key.

    Null keys count as one key ("collapse"), or rows with a null or empty key go ("drop").
    Every map task sends at most one row per key, so a hot key costs no more than others.
    """
    if nulls == "drop":
        for key in keys:
            df = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    elif nulls != "collapse":
        raise ValueError(f"nulls must be 'collapse' or 'drop', not {nulls!r}")
    # Addresses and texts often begin alike; sorting by a hash first settles most comparisons.
    return top_n_per_group(df, [F.xxhash64(*keys), *keys], order_by, 1)


def dedupe_chain(df: DataFrame, *key_lists: list[str], order_by: list) -> DataFrame:
    """One keep-first pass after the other, each among the survivors of the one before."""
    for keys in key_lists:
        df = dedupe(df, keys, order_by)
    return df


def first_valid(df: DataFrame, valid: Column, order_by: list) -> DataFrame:
    """The first row that satisfies a condition."""
    return df.where(valid).orderBy(*_as_columns(order_by)).limit(1)


def with_sequential_id(df: DataFrame, order_by: list, name: str = "id", start: int = 1) -> DataFrame:
    """Number rows without gaps in a total order, without one task seeing all rows.

    Rows are range-partitioned and sorted, then stored, since the numbering reads them
    twice and both readings have to see the same ranges; a row's number is its place in its
    partition plus the sizes of the partitions before, of which there is one row each.
    """
    order = _as_columns(order_by)
    ranged = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ranged",
    )
    block = F.shiftright("place", 33).alias("block")
    sizes = ranged.groupBy(block).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    in_block = F.col("place").bitwiseAND((1 << 33) - 1)
    return (
        ranged.withColumn("block", block)
        .join(F.broadcast(offsets), "block")
        .withColumn(name, F.col("offset") + in_block + start)
        .drop("block", "place", "offset")
    )


def top_n(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """The first `n` rows of a total order; a large n is cut by number instead of in one task."""
    if n <= 10 * NATIVE_LIMIT:
        return df.orderBy(*_as_columns(order_by)).limit(n)
    return (
        with_sequential_id(df, order_by, name="place_in_order")
        .where(F.col("place_in_order") <= n)
        .drop("place_in_order")
    )
