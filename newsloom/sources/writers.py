"""Stage outputs; each is a directory of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "lineSep": "\n",
    "encoding": "UTF-8",
}
MAX_RECORDS_PER_FILE = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; null and empty text are both empty fields."""
    df.write.options(**CSV, maxRecordsPerFile=MAX_RECORDS_PER_FILE).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, nulls written out, non-ASCII text as it is."""
    df.write.options(ignoreNullFields=False, maxRecordsPerFile=MAX_RECORDS_PER_FILE).json(path)


def write_partitioned(df: DataFrame, path: str, by: str = "ticker") -> None:
    """One folder per value of `by`.

    The rebalance lets Spark gather small values and split a hot one over several tasks.
    """
    df.hint("rebalance", F.col(by)).write.partitionBy(by).options(
        **CSV, maxRecordsPerFile=MAX_RECORDS_PER_FILE
    ).csv(path)


def append_column_version(df: DataFrame, base: str, version: int) -> str:
    """Write a table with added columns as the next version beside the one it was read from.

    The number is noted in a small table of versions once the rows are written.
    """
    path = f"{base}/v{version}"
    df.write.parquet(path)
    df.sparkSession.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").parquet(f"{base}/versions")
    return path


def latest_version(spark: SparkSession, base: str) -> DataFrame:
    """The highest version written by `append_column_version`."""
    highest = spark.read.schema("version int").parquet(f"{base}/versions").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{base}/v{highest}")
