"""Data sets behind the dashboard (the HTTP server itself is not built)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline import config as C
from forgeline.functions.time import hours_between, ts_literal
from forgeline.operators.metrics import latest_event_per_machine
from forgeline.plans.joins import lookup_join
from forgeline.plans.materialize import one_row


def telemetry_status(telemetry: DataFrame, machines: DataFrame, as_of: dt.datetime,
                     silence_hours: float = C.TELEMETRY_SILENCE_HOURS) -> DataFrame:
    """Every machine of the dimension: last event, hours since (1 decimal) and
    status active (<= silence_hours), silent, or no_data."""
    return status_of(latest_event_per_machine(telemetry), machines, as_of, silence_hours)


def status_of(latest: DataFrame | None, machines: DataFrame, as_of: dt.datetime,
              silence_hours: float = C.TELEMETRY_SILENCE_HOURS) -> DataFrame:
    """The same from the last event of each machine; without any telemetry
    (None) every machine has ``no_data``."""
    if latest is None:
        latest = machines.sparkSession.createDataFrame([], "machine_id string, last_event timestamp_ntz")
    joined = lookup_join(machines.select("machine_id"), latest, "machine_id", null_safe=True)
    hours = hours_between(F.col("last_event"), ts_literal(as_of))
    return joined.select(
        "machine_id",
        "last_event",
        F.round(hours, 1).alias("hours_since"),
        F.when(F.col("last_event").isNull(), F.lit(C.NO_DATA))
        .when(hours > silence_hours, F.lit(C.SILENT))
        .otherwise(F.lit(C.ACTIVE)).alias("status"),
    )


def dashboard_kpis(spark: SparkSession, downtime_metrics: DataFrame | None, health: DataFrame | None,
                   status: DataFrame | None, scrap: DataFrame | None, alert_totals: DataFrame,
                   temp_threshold: float = C.TEMP_THRESHOLD_C,
                   scrap_threshold: float = C.SCRAP_RATE_THRESHOLD) -> DataFrame:
    """One row of header counts, zero for a table that is absent; one
    aggregate for each table (combined without a cross join or scalar subqueries)."""
    def counts(df: DataFrame | None, **conditions) -> DataFrame:
        if df is None:
            return spark.createDataFrame([tuple(0 for _ in conditions)], ", ".join(f"{n} long" for n in conditions))
        return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])

    everyone = F.lit(True)
    row = one_row(
        counts(downtime_metrics, factories=everyone),
        counts(health, machines=everyone, abnormal=F.coalesce(F.col("max_temperature_c"), F.lit(0.0)) > temp_threshold),
        counts(status, silent=F.col("status") != C.ACTIVE),
        counts(scrap, high_scrap=F.coalesce(F.col("scrap_rate"), F.lit(0.0)) > scrap_threshold),
        alert_totals.select(F.col("total_alerts").alias("alerts")),
    )
    return row.select("factories", "machines", "abnormal", "silent", "high_scrap",
                      F.coalesce(F.col("alerts"), F.lit(0)).cast("bigint").alias("alerts"))


def dashboard_abnormal(health: DataFrame, n: int = C.TOP_N,
                       temp_threshold: float = C.TEMP_THRESHOLD_C,
                       danger: float = C.DANGER_TEMP_C) -> DataFrame:
    max_t = F.coalesce(F.col("max_temperature_c"), F.lit(0.0))
    top = health.where(max_t > temp_threshold).orderBy(max_t.desc(), F.col("machine_id").asc_nulls_first()).limit(n)
    return top.select(
        "machine_id", "max_temperature_c", "avg_temperature_c", "max_vibration_mm_s", "event_count",
        F.when(max_t > danger, F.lit(C.DANGER)).otherwise(F.lit(C.WARN)).alias("css_class"),
    )


def dashboard_high_scrap(scrap: DataFrame, n: int = C.TOP_N,
                         threshold: float = C.SCRAP_RATE_THRESHOLD) -> DataFrame:
    rate = F.coalesce(F.col("scrap_rate"), F.lit(0.0))
    return scrap.where(rate > threshold).orderBy(rate.desc(), F.col("machine_id").asc_nulls_first()).limit(n) \
        .select("machine_id", "scrap_rate", "total_scrap_units", "total_units_produced")


def dashboard_silent(status: DataFrame, n: int = C.TOP_N) -> DataFrame:
    return status.where(F.col("status") != C.ACTIVE) \
        .orderBy(F.col("machine_id").asc_nulls_first()).limit(n)


def dashboard_downtime(downtime_metrics: DataFrame) -> DataFrame:
    return downtime_metrics.select(
        "factory_id", "total_downtime_minutes", "avg_downtime_minutes", "downtime_event_count",
    ).orderBy(F.col("total_downtime_minutes").desc(), F.col("factory_id").asc_nulls_first())
