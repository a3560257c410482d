"""Mergeable metric state: for each part of a staged table and each key the
sums, counts and maxima from which the metric tables are merged. Merging is
associative, so a part that is staged again replaces its own partials and no
other part is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions.numeric import nan_ignoring_max, safe_ratio


def _mean(total: str, count: str):
    """Null where nothing was counted, as an average over no rows."""
    return F.when(F.col(count) > 0, F.col(total) / F.col(count))


def health_partials(telemetry: DataFrame, part: str) -> DataFrame:
    return telemetry.groupBy(part, "machine_id").agg(
        F.sum("temperature_c").alias("sum_t"), F.count("temperature_c").alias("n_t"), nan_ignoring_max("temperature_c").alias("max_t"),
        F.sum("vibration_mm_s").alias("sum_v"), F.count("vibration_mm_s").alias("n_v"), nan_ignoring_max("vibration_mm_s").alias("max_v"),
        F.sum("power_kw").alias("sum_p"), F.count("power_kw").alias("n_p"), F.count("event_id").alias("events"))


def merge_health(partials: DataFrame) -> DataFrame:
    """``metrics.machine_health_features`` of all parts together."""
    sums = [F.sum(c).alias(c) for c in ("sum_t", "n_t", "sum_v", "n_v", "sum_p", "n_p", "events")]
    merged = partials.groupBy("machine_id").agg(*sums, nan_ignoring_max("max_t").alias("max_t"), nan_ignoring_max("max_v").alias("max_v"))
    return merged.select(
        "machine_id", _mean("sum_t", "n_t").alias("avg_temperature_c"), F.col("max_t").alias("max_temperature_c"),
        _mean("sum_v", "n_v").alias("avg_vibration_mm_s"), F.col("max_v").alias("max_vibration_mm_s"),
        _mean("sum_p", "n_p").alias("avg_power_kw"), F.col("events").alias("event_count"))


def latest_partials(telemetry: DataFrame, part: str) -> DataFrame:
    return telemetry.groupBy(part, "machine_id").agg(F.max("timestamp").alias("last_event"))


def merge_latest(partials: DataFrame) -> DataFrame:
    """``metrics.latest_event_per_machine`` of all parts together."""
    return partials.groupBy("machine_id").agg(F.max("last_event").alias("last_event"))


def downtime_partials(maintenance: DataFrame, part: str) -> DataFrame:
    """By machine, of the rows with downtime; the factory is looked up when they are merged."""
    down = maintenance.where(F.col("downtime_minutes") > 0)
    return down.groupBy(part, "machine_id").agg(
        F.sum("downtime_minutes").alias("total"), F.count("downtime_minutes").alias("events"), F.max("downtime_minutes").alias("most"))


def merge_downtime(partials: DataFrame, machines: DataFrame) -> DataFrame:
    """``metrics.factory_downtime_metrics`` of all parts together."""
    by_machine = partials.groupBy("machine_id").agg(F.sum("total").alias("total"), F.sum("events").alias("events"), F.max("most").alias("most"))
    placed = by_machine.join(machines.select("machine_id", "factory_id"), "machine_id", "left")
    merged = placed.groupBy("factory_id").agg(F.sum("total").alias("total"), F.sum("events").alias("events"), F.max("most").alias("most"))
    return merged.select(
        "factory_id", F.col("total").alias("total_downtime_minutes"), _mean("total", "events").alias("avg_downtime_minutes"),
        F.col("events").alias("downtime_event_count"), F.col("most").alias("max_single_downtime_minutes"))


def scrap_partials(production: DataFrame, part: str) -> DataFrame:
    return production.groupBy(part, "machine_id").agg(F.sum("units_produced").alias("units"), F.sum("scrap_units").alias("scrap"))


def merge_scrap(partials: DataFrame) -> DataFrame:
    """``metrics.scrap_rate_metrics`` of all parts together."""
    merged = partials.groupBy("machine_id").agg(F.sum("units").alias("total_units_produced"), F.sum("scrap").alias("total_scrap_units"))
    return merged.withColumn("scrap_rate", safe_ratio(F.col("total_scrap_units"), F.col("total_units_produced")))


def effectiveness_partials(maintenance: DataFrame, part: str) -> DataFrame:
    return maintenance.groupBy(part, "maintenance_type").agg(
        F.sum("downtime_minutes").alias("total"), F.count("downtime_minutes").alias("events"))


def merge_effectiveness(partials: DataFrame) -> DataFrame:
    """``metrics.maintenance_effectiveness_metrics`` of all parts together."""
    merged = partials.groupBy("maintenance_type").agg(F.sum("total").alias("total"), F.sum("events").alias("events"))
    return merged.select("maintenance_type", _mean("total", "events").alias("avg_downtime_minutes"),
                         F.col("total").alias("total_downtime_minutes"), F.col("events").alias("event_count"))
