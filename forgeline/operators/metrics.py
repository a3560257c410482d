"""Metric tables: group-by aggregations with partial (map-side) aggregation,
so a key holding a third of all rows is combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions.numeric import nan_ignoring_max, safe_ratio


def machine_health_features(telemetry: DataFrame) -> DataFrame:
    """Per machine: mean/max temperature, mean/max vibration, mean power and
    the number of non-null event ids. Nulls are skipped, NaN is skipped by
    the maxima; means are plain double means."""
    return telemetry.groupBy("machine_id").agg(
        F.avg("temperature_c").alias("avg_temperature_c"),
        nan_ignoring_max("temperature_c").alias("max_temperature_c"),
        F.avg("vibration_mm_s").alias("avg_vibration_mm_s"),
        nan_ignoring_max("vibration_mm_s").alias("max_vibration_mm_s"),
        F.avg("power_kw").alias("avg_power_kw"),
        F.count("event_id").alias("event_count"),
    )


def factory_downtime_metrics(downtime_fact: DataFrame) -> DataFrame:
    """Per factory (null factory is a group). An empty input gives an empty
    table (the reference keeps a stale file instead)."""
    return downtime_fact.groupBy("factory_id").agg(
        F.sum("downtime_minutes").alias("total_downtime_minutes"),
        F.avg("downtime_minutes").alias("avg_downtime_minutes"),
        F.count("downtime_minutes").alias("downtime_event_count"),
        F.max("downtime_minutes").alias("max_single_downtime_minutes"),
    )


def scrap_rate_metrics(production: DataFrame) -> DataFrame:
    """Per machine: units, scrap and ``scrap / max(units, 1.0)``. (The
    reference also looks up the factory here and never uses it; the lookup
    is left out.)"""
    agg = production.groupBy("machine_id").agg(
        F.sum("units_produced").alias("total_units_produced"),
        F.sum("scrap_units").alias("total_scrap_units"),
    )
    return agg.withColumn("scrap_rate", safe_ratio(F.col("total_scrap_units"), F.col("total_units_produced")))


def maintenance_effectiveness_metrics(maintenance: DataFrame) -> DataFrame:
    """Per maintenance type over all logs (zero downtime included)."""
    return maintenance.groupBy("maintenance_type").agg(
        F.avg("downtime_minutes").alias("avg_downtime_minutes"),
        F.sum("downtime_minutes").alias("total_downtime_minutes"),
        F.count("downtime_minutes").alias("event_count"),
    )


def group_by_agg(df: DataFrame, group_col: str, agg_specs: list[tuple[str, str, str]]) -> DataFrame:
    """Generic group-by: ``[(source column, aggregate name, output name)]``.
    Aggregate names are Spark SQL aggregate functions (sum, avg, mean, min,
    max, count, ...)."""
    names = {"mean": "avg"}
    exprs = [F.expr(f"{names.get(agg, agg)}(`{src}`)").alias(out) for src, agg, out in agg_specs]
    return df.groupBy(group_col).agg(*exprs)


def latest_event_per_machine(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("machine_id").agg(F.max("timestamp").alias("last_event"))
