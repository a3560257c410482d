from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_non_negative(col: str | Column) -> Column:
    """``max(x, 0)``; a null becomes 0 as in the reference."""
    c = F.col(col) if isinstance(col, str) else col
    return F.greatest(c, F.lit(0).cast("bigint"))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / max(den, 1.0)`` in double."""
    return num.cast("double") / F.greatest(den.cast("double"), F.lit(1.0))


def nan_ignoring_max(col: str) -> Column:
    """Max that skips NaN (Spark's max returns NaN when one is present)."""
    return F.max(F.nanvl(F.col(col), F.lit(None).cast("double")))

