"""Staging: clean, cast and de-duplicate the raw tables.

Every function is a pure DataFrame transformation, so the same code serves
batch jobs, streaming ``foreachBatch`` and tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.config import PARTITION_COLUMNS
from forgeline.functions.numeric import clamp_non_negative
from forgeline.functions.text import normalize_string
from forgeline.functions.time import parse_date_strict, parse_timestamp_strict
from forgeline.schemas import SCAN_ORDER_COLUMNS

TELEMETRY_COLUMNS = ["event_id", "machine_id", "factory_id", "timestamp", "temperature_c",
                     "vibration_mm_s", "power_kw", "status"]
MACHINE_COLUMNS = ["machine_id", "factory_id", "machine_type", "install_date", "status"]
MAINTENANCE_COLUMNS = ["maintenance_id", "machine_id", "timestamp", "maintenance_type",
                       "part_replaced", "downtime_minutes"]
PRODUCTION_COLUMNS = ["date", "machine_id", "shift", "units_produced", "scrap_units", "operator_id"]


def normalize_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """Lower-case and strip spaces of ``cols``; absent columns are skipped."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: normalize_string(c) for c in present}) if present else df


def cast_timestamp(df: DataFrame, col: str) -> DataFrame:
    if col not in df.columns:
        return df
    if dict(df.dtypes)[col] != "string":
        return df
    return df.withColumn(col, parse_timestamp_strict(col))


def cast_date(df: DataFrame, col: str) -> DataFrame:
    if col not in df.columns or dict(df.dtypes)[col] != "string":
        return df
    return df.withColumn(col, parse_date_strict(col))


def clamp_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: clamp_non_negative(c) for c in cols})


def scan_order(df: DataFrame) -> list[str]:
    """Columns giving the order in which raw rows arrived: event-hour
    partition, ingest batch, the file's modification time and name, offset in file, row in split."""
    return [c for c in (*PARTITION_COLUMNS, *SCAN_ORDER_COLUMNS) if c in df.columns]


def keep_last(df: DataFrame, key: str, order_cols: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the one that arrived last; null keys form one group.

    ``row_number() == 1`` over the key lets Spark plan a partial
    WindowGroupLimit before the shuffle, so a key repeated in a third of all
    rows is cut to one row per map task before it is shuffled.
    """
    order_cols = scan_order(df) if order_cols is None else order_cols
    if not order_cols:
        raise ValueError("keep_last needs scan-order columns to decide the last row")
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


# -- rows cleaned and cast, with all their columns, before one is kept for each key --

def prepare_telemetry(raw: DataFrame) -> DataFrame:
    return cast_timestamp(normalize_strings(raw, ["machine_id", "factory_id", "status"]), "timestamp")


def prepare_machines(raw: DataFrame) -> DataFrame:
    return cast_date(normalize_strings(raw, ["machine_id", "factory_id", "machine_type", "status"]), "install_date")


def prepare_maintenance(raw: DataFrame) -> DataFrame:
    df = cast_timestamp(normalize_strings(raw, ["machine_id", "maintenance_type", "part_replaced"]), "timestamp")
    return clamp_columns(df, ["downtime_minutes"])


def prepare_production(raw: DataFrame) -> DataFrame:
    df = cast_date(normalize_strings(raw, ["machine_id", "shift", "operator_id"]), "date")
    return clamp_columns(df, ["units_produced", "scrap_units"])


# -- staged tables from the whole raw history --------------------------------------

def stage_telemetry(raw: DataFrame) -> DataFrame:
    return keep_last(prepare_telemetry(raw), "event_id").select(*TELEMETRY_COLUMNS)


def stage_machines(raw: DataFrame) -> DataFrame:
    """Union of all snapshots, newest row per machine (a machine missing from
    a newer snapshot stays)."""
    return keep_last(prepare_machines(raw), "machine_id").select(*MACHINE_COLUMNS)


def stage_maintenance(raw: DataFrame) -> DataFrame:
    return keep_last(prepare_maintenance(raw), "maintenance_id").select(*MAINTENANCE_COLUMNS)


def stage_production(raw: DataFrame) -> DataFrame:
    """No de-duplication for production (as in the reference)."""
    return prepare_production(raw).select(*PRODUCTION_COLUMNS)
