"""Operational alerts. Each alert has an items DataFrame (one row per
affected machine or run) and a header built from it by aggregation, so no
machine list is gathered in one place. ``as_of`` replaces the wall clock."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline import config as C
from forgeline.functions.messages import message
from forgeline.functions.text import decimal_text
from forgeline.functions.time import hours_between, ts_literal
from forgeline.operators.metrics import latest_event_per_machine
from forgeline.plans.joins import lookup_join

HEADER_COLUMNS = ["alert_type", "severity", "message", "item_count"]


def _header(items: DataFrame, alert_type: str, severity: Column, template: str, **params) -> DataFrame:
    """One header row when ``items`` is not empty, else no row; ``{n}`` in
    the message template is the number of items."""
    agg = items.agg(F.count(F.lit(1)).alias("item_count"))
    return agg.where(F.col("item_count") > 0).select(
        F.lit(alert_type).alias("alert_type"),
        severity.alias("severity"),
        message(template, n=F.col("item_count"), **params).alias("message"),
        "item_count",
    )


def telemetry_silence_items(telemetry: DataFrame, machines: DataFrame, as_of: dt.datetime,
                            silence_hours: float = C.TELEMETRY_SILENCE_HOURS) -> DataFrame:
    """Machines of the dimension with no event, or whose last event is more
    than ``silence_hours`` before ``as_of`` (hours rounded to 1 decimal)."""
    latest = latest_event_per_machine(telemetry)
    ids = machines.select("machine_id").distinct()
    joined = lookup_join(ids, latest, "machine_id", null_safe=True)
    hours = hours_between(F.col("last_event"), ts_literal(as_of))
    return joined.where(F.col("last_event").isNull() | (hours > silence_hours)).select(
        "machine_id", "last_event", F.round(hours, 1).alias("hours_since"))


def telemetry_silence_alert(items: DataFrame, silence_hours: float = C.TELEMETRY_SILENCE_HOURS) -> DataFrame:
    return _header(items, C.ALERT_TYPES[0], F.lit(C.WARNING), C.MSG_SILENCE, hours=float(silence_hours))


def temperature_items(health: DataFrame, threshold: float = C.TEMP_THRESHOLD_C) -> DataFrame:
    return health.where(F.col("max_temperature_c") > threshold).select(
        "machine_id",
        F.round("max_temperature_c", 1).alias("max_temperature_c"),
        F.round("avg_temperature_c", 1).alias("avg_temperature_c"),
    )


def temperature_alert(items: DataFrame, threshold: float = C.TEMP_THRESHOLD_C,
                      critical: float = C.TEMP_CRITICAL_C) -> DataFrame:
    agg = items.agg(F.count(F.lit(1)).alias("item_count"),
                    F.max(F.col("max_temperature_c") > critical).alias("any_critical"))
    return agg.where(F.col("item_count") > 0).select(
        F.lit(C.ALERT_TYPES[1]).alias("alert_type"),
        F.when(F.col("any_critical"), F.lit(C.CRITICAL)).otherwise(F.lit(C.WARNING)).alias("severity"),
        message(C.MSG_TEMPERATURE, n=F.col("item_count"), threshold=float(threshold)).alias("message"),
        "item_count",
    )


def scrap_items(scrap: DataFrame, threshold: float = C.SCRAP_RATE_THRESHOLD) -> DataFrame:
    return scrap.where(F.col("scrap_rate") > threshold).select(
        "machine_id",
        F.round("scrap_rate", 4).alias("scrap_rate"),
        F.col("total_units_produced").alias("total_units"),
        F.col("total_scrap_units").alias("total_scrap"),
    )


def scrap_alert(items: DataFrame, threshold: float = C.SCRAP_RATE_THRESHOLD) -> DataFrame:
    return _header(items, C.ALERT_TYPES[2], F.lit(C.WARNING), C.MSG_SCRAP, percent=f"{threshold * 100:.0f}")


def late_data_alerts(state: DataFrame, as_of: dt.datetime,
                     late_hours: float = C.LATE_DATA_HOURS) -> DataFrame:
    """From the high-water mark state (source, mark): maintenance mark older
    than ``late_hours`` -> warning; production mark 1 day old -> info, more
    -> warning. Columns: header columns + source, last_watermark, age."""
    as_of_ts = ts_literal(as_of)
    maint = state.where((F.col("source") == "maintenance_logs") & (F.coalesce(F.col("mark"), F.lit("")) != ""))
    hours = hours_between(F.to_timestamp_ntz("mark"), as_of_ts)
    maint = maint.where(hours > late_hours).select(
        F.lit(C.ALERT_TYPES[3]).alias("alert_type"),
        F.lit(C.WARNING).alias("severity"),
        message(C.MSG_MAINTENANCE_LATE, hours=decimal_text(hours, 1), limit=float(late_hours)).alias("message"),
        F.lit(1).cast("bigint").alias("item_count"),
        F.lit("maintenance").alias("source"),
        F.col("mark").alias("last_watermark"),
        F.round(hours, 1).alias("age"),
    )
    prod = state.where((F.col("source") == "production") & (F.coalesce(F.col("mark"), F.lit("")) != ""))
    days = F.datediff(F.lit(as_of.date().isoformat()).cast("date"), F.to_date("mark"))
    prod = prod.where(days > 0).select(
        F.lit(C.ALERT_TYPES[3]).alias("alert_type"),
        F.when(days <= 1, F.lit(C.INFO)).otherwise(F.lit(C.WARNING)).alias("severity"),
        message(C.MSG_PRODUCTION_LATE, days=days).alias("message"),
        F.lit(1).cast("bigint").alias("item_count"),
        F.lit("production").alias("source"),
        F.col("mark").alias("last_watermark"),
        days.cast("double").alias("age"),
    )
    return maint.unionByName(prod)


def failed_run_items(history: DataFrame, as_of: dt.datetime,
                     since_hours: int = C.FAILED_RUN_WINDOW_HOURS) -> DataFrame:
    cutoff = ts_literal(as_of - dt.timedelta(hours=since_hours))
    return history.where((F.col("timestamp") >= cutoff) & (F.col("status") != C.SUCCESS))


def pipeline_failure_alert(items: DataFrame, since_hours: int = C.FAILED_RUN_WINDOW_HOURS) -> DataFrame:
    return _header(items, C.ALERT_TYPES[4], F.lit(C.CRITICAL), C.MSG_FAILURES, hours=since_hours)


def alert_report(headers: list[DataFrame]) -> DataFrame:
    """Union of alert headers in check order (``alert_order``)."""
    parts = [h.select(*HEADER_COLUMNS, F.lit(i).alias("alert_order")) for i, h in enumerate(headers)]
    return reduce(DataFrame.unionByName, parts)


def alert_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("severity") == C.CRITICAL).alias("critical"),
        F.count_if(F.col("severity") == C.WARNING).alias("warnings"),
    )
