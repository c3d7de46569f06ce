"""Line cleaning by grouping, for texts of very many lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import tidy_lines
from newsloom.operators.ranking import dedupe


def clean_lines(df: DataFrame, row_id: str, col: str) -> DataFrame:
    """(row_id, col): as `light_clean`, at a cost that grows with the lines, not their square.

    Lines are grouped by row and lower-cased text; the regrouping holds one text at a time.
    """
    lines = df.select(row_id, F.posexplode(tidy_lines(F.col(col))).alias("line_no", "line"))
    first = dedupe(lines.withColumn("low", F.lower("line")), [row_id, "low"], ["line_no"])
    cleaned = first.groupBy(row_id).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda p: p["line"]
            ),
            "\n",
        ).alias("cleaned")
    )
    # A text of white space only has no lines left, an empty one no result.
    return df.select(row_id, col).join(cleaned, row_id, "left").select(
        row_id,
        F.when(F.col(col) != "", F.coalesce("cleaned", F.lit(""))).alias(col),
    )
