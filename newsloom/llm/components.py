"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stored

MOST_ROUNDS = 60


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them; edges point down already."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionAll(least.select("a", F.col("least").alias("b")))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of `edges` (a, b) that have a neighbour; the root is the least node.

    Alternates the two stars, whose work is sums and joins by node, until nothing changes; a hub's edges
    are reduced before the shuffle and split by adaptive execution where they are joined. Ends of an
    edge must be numbers and not null; an empty graph has no rows.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(_clean(down), "edges")
    before = _signature(now)
    for _ in range(MOST_ROUNDS):
        now = stored(_clean(_small_star(_clean(_large_star(now)))), "edges")
        after = _signature(now)
        if after == before:
            roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
        before = after
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
