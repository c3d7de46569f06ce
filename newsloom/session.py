"""Session settings, lineage cuts and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A hot partition is split even if a later step then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "newsloom", **extra: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for checkpoints that `spark.checkpoint.dir` names, reachable from every executor."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        # One machine, as in tests: a folder that goes when the process ends.
        holder = tempfile.TemporaryDirectory(prefix="newsloom-", ignore_cleanup_errors=True)
        _LOCAL.append(holder)
        named = holder.name
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


_LOCAL: list[tempfile.TemporaryDirectory] = []


#: A table under this size for each core is dealt out by row before rows are worked on.
SMALL_SHARE = 32 << 20


def spread(df: DataFrame, key: str) -> DataFrame:
    """`df`, dealt to the session's shuffle partitions by `key` if it is too small for its files to keep all cores busy.

    A file of one row group is one task, however many cores wait and however large it is. Larger tables whose splits are within
    `SMALL_SHARE`, of at least as many files as cores, are not moved; others are dealt to twice as many partitions as they hold of it.
    """
    spark = df.sparkSession
    cores, parts = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= SMALL_SHARE * cores:
        files = len(df.inputFiles())
        splits = df._jdf.queryExecution().toRdd().getNumPartitions()
        if not files or (files >= cores and splits * SMALL_SHARE >= size):
            return df
        parts = max(parts, 2 * size // SMALL_SHARE)
    return df.repartition(parts, key)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path beside the checkpoints, reachable from every executor."""
    return os.path.join(checkpoint_root(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table beside the checkpoints and go on from there.

    The lineage ends at the files, which outlive executors; later steps read only the
    columns they need and know the table's size.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return _remembered(df.sparkSession.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, key: str, label: str, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """As `stored`, in buckets by `key`: tables with the same buckets join on it without a shuffle.

    Rows that lie by `key` as they are (`dealt`) are written where they are, and do not move for it.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch_dir(spark, label), f"newsloom_{uuid.uuid4().hex}"
    writer = (df if dealt else df.repartition(n, key)).write.bucketBy(n, key).sortBy(key).option("path", path)
    writer.saveAsTable(name)
    return _remembered(spark.table(name), path, name)


def _remembered(table: DataFrame, path: str, name: str = "") -> DataFrame:
    table.scratch_path, table.scratch_name = path, name
    return table


def released(table: DataFrame) -> None:
    """Free the space of a table that `stored` or `bucketed` made and that nothing reads any more."""
    path, name = getattr(table, "scratch_path", ""), getattr(table, "scratch_name", "")
    if name:
        table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        table.sparkSession.range(0).write.mode("overwrite").parquet(path)
