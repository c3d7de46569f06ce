"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: the space and the control characters 9 to 13.
GAPS = " \t\n\x0b\f\r"
GAP_RUN = "[ \\t-\\r]+"
WORD = "[^ \\t-\\r]+"


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as empty text."""
    as_text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.pmod(F.crc32(F.coalesce(as_text, F.lit(""))), F.lit(parts))


def kept_row(df: DataFrame, **computed: Column) -> DataFrame:
    """The whole row as one struct `row` beside computed columns, so that no names clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(n) for n, c in computed.items()])


def opened(df: DataFrame, *added: str) -> DataFrame:
    """The columns of `row` again, and `added`, which replace columns of the same name."""
    fields = [f for f in df.schema["row"].dataType.names if f not in added]
    return df.select(*[F.col("row").getField(f).alias(f) for f in fields], *added)


def unused(df: DataFrame, name: str) -> str:
    """`name`, made longer until `df` has no such column."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


def key_of(source: Column) -> Column:
    """A join key that tells a null source from every other."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def release(df: DataFrame, path: str) -> None:
    """Free the space of a stored table that nothing reads any more."""
    df.sparkSession.range(0).write.mode("overwrite").parquet(path)
