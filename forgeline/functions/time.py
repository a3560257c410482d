from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from forgeline.config import DATE_FORMAT, TIMESTAMP_FORMAT


def parse_timestamp_strict(col: str | Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss`` exactly, to TIMESTAMP_NTZ. A fraction, a zone
    or a blank separator raises under ANSI; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp_ntz(c, F.lit(TIMESTAMP_FORMAT))


def parse_date_strict(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c, DATE_FORMAT)


def ts_literal(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end`` (both zone-less, read as UTC) as double."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros.cast("double") / F.lit(3_600_000_000.0)


def days_between(start_date: Column, end_date: Column) -> Column:
    return F.datediff(end_date, start_date)


def time_partitions(ts: Column, with_day_hour: bool = False) -> dict[str, Column]:
    """Zero-padded partition values of a zone-less timestamp or a date
    (``year=2026/month=03[/day=01/hour=04]``), taken from its fields, so they
    do not depend on the session time zone."""
    def pad(c: Column, n: int) -> Column:
        return F.lpad(c.cast("string"), n, "0")

    parts = {"year": pad(F.year(ts), 4), "month": pad(F.month(ts), 2)}
    if with_day_hour:
        parts.update(day=pad(F.dayofmonth(ts), 2), hour=pad(F.hour(ts), 2))
    return parts
