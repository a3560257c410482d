"""High-water-mark ingestion: keep rows strictly after the last mark and
compute the next mark. Marks compare as text, like the reference (ISO text
orders like time); a late row at or below the mark is not taken again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def after_mark(df: DataFrame, col: str, mark: str | None) -> DataFrame:
    """Rows with ``col > mark`` (string compare); no mark -> all rows. The
    predicate is a plain comparison, so it reaches the Parquet scan."""
    if not mark:
        return df
    return df.where(F.col(col) > F.lit(mark))


def advance_mark(new_rows: DataFrame, col: str, source: str, old_mark: str | None) -> DataFrame:
    """One row (source, rows, mark): the max of ``col`` over the new rows, or
    the old mark when nothing is new."""
    agg = new_rows.agg(F.count(F.lit(1)).alias("rows"), F.max(col).alias("new_mark"))
    return agg.select(
        F.lit(source).alias("source"),
        "rows",
        F.coalesce(F.col("new_mark"), F.lit(old_mark).cast("string")).alias("mark"),
    )
