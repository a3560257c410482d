from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_string(col: str | Column) -> Column:
    """Lower case, then strip spaces only (a tab is kept)."""
    return F.trim(F.lower(F.col(col) if isinstance(col, str) else col))


def id_number(col: str | Column, prefix: str) -> Column:
    """Number part of an id such as ``evt_000042``: every ``prefix`` removed,
    the rest cast strictly to bigint (a non-number raises under ANSI)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c, F.lit(prefix), F.lit("")).cast("bigint")


def zero_pad(num: Column, width: int) -> Column:
    """Decimal text of an integer, zero-padded to at least ``width`` digits
    (longer numbers keep all their digits, unlike a bare ``lpad``); same
    text as ``printf('%0<width>d')`` without its per-row formatter cost."""
    digits = F.abs(num).cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.when(num < 0, F.concat(F.lit("-"), F.when(F.length(digits) >= width - 1, digits)
                                    .otherwise(F.lpad(digits, width - 1, "0")))).otherwise(padded)


def decimal_text(x: Column, scale: int) -> Column:
    """Text of ``x`` rounded to ``scale`` decimals, always with that many
    decimals. Goes through a decimal so it does not depend on printf."""
    return F.round(x, scale).cast(f"decimal(20,{scale})").cast("string")
