"""Following captured redirects to their end, and joining the outcome to articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import skew_join
from newsloom.operators.ranking import dedupe
from newsloom.session import stored

MAX_HOPS = 30  # what common HTTP clients follow before they give up


def last_edges(edges: DataFrame, captured: list | None = None) -> DataFrame:
    """One edge per address: the first in the order `captured`, and of those alike the first by content.

    Columns from_url, to_url, http_code and error; an edge with an error leads nowhere.
    """
    error = F.col("error") if "error" in edges.columns else F.lit(None).cast("string")
    plain = edges.withColumn("failure", error)
    one = dedupe(plain, ["from_url"], [*(captured or []), "to_url", "http_code", "failure"], nulls="drop")
    target = F.when(F.col("failure").isNull(), F.col("to_url"))
    return one.select("from_url", target.alias("to_url"), "http_code", F.col("failure").alias("error"))


def trace_redirects(edges: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """Where each edge's chain stands after `max_hops` hops: from_url, at, hops, code, error, ended.

    `edges` has one row per address (`last_edges`). Each round joins the chains under way with all
    and so doubles the hops covered. Chains that have ended are written once and leave the join, so
    a popular final page is never a join key; popular stations in between are split by the join.
    """
    # A target without an outgoing edge is itself an end, with no code captured.
    last = F.col("to_url").isNull()
    sources = stored(
        edges.select(
            "from_url",
            F.coalesce("to_url", "from_url").alias("at"),
            F.when(last, 0).otherwise(1).cast("bigint").alias("hops"),
            F.when(last, F.col("http_code")).cast("int").alias("code"),
            F.when(last, F.col("error")).alias("error"),
            last.alias("ended"),
        ),
        "redirects",
    )
    done, under_way = sources.where("ended"), sources.where("not ended")
    covered = 1
    while True:
        step = done.unionByName(under_way).select(
            F.col("from_url").alias("at"), *[F.col(c).alias(f"next_{c}") for c in ("at", "hops", "code", "error", "ended")]
        )
        moved = stored(
            skew_join(under_way, step, ["at"], spread_by=["from_url"]).select(
                "from_url",
                F.coalesce("next_at", "at").alias("at"),
                (F.col("hops") + F.coalesce("next_hops", F.lit(0))).alias("hops"),
                F.col("next_code").alias("code"),
                F.col("next_error").alias("error"),
                (F.col("next_at").isNull() | F.col("next_ended")).alias("ended"),
            ),
            "redirects",
        )
        done, under_way = done.unionByName(moved.where("ended")), moved.where("not ended")
        covered *= 2
        # One round more than the hops need settles whether the last station is an end.
        if covered > max_hops or under_way.isEmpty():
            return done.unionByName(under_way)


def resolve_redirects(
    urls: DataFrame, edges: DataFrame, max_hops: int = MAX_HOPS, unseen_code: int = 200, captured: list | None = None
) -> DataFrame:
    """One row per distinct non-null url: url, url_original, status, http_code.

    Without a captured code (`unseen_code`) an address counts as reached. A captured error (`timeout`,
    `request_error:X`, `error:X`) is the status of every chain that meets it. Of repeated edges of an
    address the first in the order `captured` counts.
    """
    wanted = urls.select("url").where(F.col("url").isNotNull()).distinct()
    traced = trace_redirects(last_edges(edges, captured), max_hops).withColumnRenamed("from_url", "url")
    found = wanted.join(traced, "url", "left")
    code = F.coalesce("code", F.lit(unseen_code))
    lost = F.col("at").isNotNull() & (~F.col("ended") | (F.col("hops") > max_hops))
    failed = ~lost & F.col("error").isNotNull()
    good = ~lost & ~failed & (code < 400)
    return found.select(
        "url",
        F.when(good, F.coalesce("at", "url")).alias("url_original"),
        F.when(lost, "too_many_redirects")
        .when(failed, F.col("error"))
        .when(good, "ok")
        .otherwise("http_error")
        .alias("status"),
        F.when(~lost & ~failed, code).alias("http_code"),
    )


def enrich_urls(
    df: DataFrame, resolved: DataFrame, spread_by: list[str], copies: str | None = None
) -> DataFrame:
    """Add url_original, status and http_code by url; `resolved` has one row per url.

    Resolving every row on its own and joining the results back would repeat a row once per
    row with the same url. Those repeats are not written out; `copies` names a column for
    their number.
    """
    if copies:
        times = df.where(F.col("url").isNotNull()).groupBy("url").agg(F.count(F.lit(1)).alias(copies))
        resolved = resolved.join(times, "url", "left")
    joined = skew_join(df, resolved, ["url"], spread_by=spread_by)
    return joined.withColumn(copies, F.coalesce(copies, F.lit(1))) if copies else joined
