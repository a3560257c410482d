"""The seven fixed business questions over the analytics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline import config as C
from forgeline.functions.text import decimal_text


def _truthy(c: F.Column) -> F.Column:
    """Python truthiness of a number: null and 0 are false."""
    return F.coalesce(c != 0, F.lit(False))


def machines_trending_toward_failure(health: DataFrame) -> DataFrame:
    """Machines with at least one risk factor; ``risk_factors`` lists them as
    text. Sorted by rounded mean temperature, highest first."""
    avg_t, avg_v, max_t = F.col("avg_temperature_c"), F.col("avg_vibration_mm_s"), F.col("max_temperature_c")
    reasons = F.array_compact(F.array(
        F.when(_truthy(avg_t) & (avg_t > C.TREND_AVG_TEMP_C),
               F.concat(F.lit("avg_temp="), decimal_text(avg_t, 1), F.lit("°C"))),
        F.when(_truthy(avg_v) & (avg_v > C.TREND_AVG_VIBRATION),
               F.concat(F.lit("avg_vibration="), decimal_text(avg_v, 2), F.lit("mm/s"))),
        F.when(_truthy(max_t) & (max_t > C.TREND_MAX_TEMP_C),
               F.concat(F.lit("max_temp="), decimal_text(max_t, 1), F.lit("°C"))),
    ))
    out = health.select(
        "machine_id",
        F.when(_truthy(avg_t), F.round(avg_t, 1)).alias("avg_temperature_c"),
        F.when(_truthy(avg_v), F.round(avg_v, 2)).alias("avg_vibration_mm_s"),
        F.when(_truthy(max_t), F.round(max_t, 1)).alias("max_temperature_c"),
        reasons.alias("risk_factors"),
    ).where(F.size("risk_factors") > 0)
    return out.orderBy(F.coalesce(F.col("avg_temperature_c"), F.lit(0.0)).desc(), F.col("machine_id"))


def next_readings(telemetry: DataFrame) -> DataFrame:
    """(machine_id, timestamp, event_id, temperature_c, next_status,
    next_timestamp) of every reading that has a next one of its machine, by time, then event id.

    The window looks at the readings of one machine in one hour, so a machine with
    much of the telemetry is spread over its hours. The last reading of
    an hour meets the first one of the machine's next hour through one row for
    each machine and hour, which combine in the map tasks."""
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)")  # null times come first
    order = ["timestamp", "event_id"]
    rows = telemetry.select("machine_id", hour.alias("hour"), *order, "temperature_c", "status")
    after = F.struct("status", "timestamp")
    in_hour = Window.partitionBy("machine_id", "hour").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    inside = rows.select("machine_id", *order, "temperature_c", F.lead(after).over(in_hour).alias("next"))
    edges = rows.groupBy("machine_id", "hour").agg(
        F.min(F.struct(*order, "status")).alias("first"), F.max(F.struct(*order, "temperature_c")).alias("last"))
    by_hour = Window.partitionBy("machine_id").orderBy(F.col("hour").asc_nulls_first())
    between = edges.select("machine_id", "last.*", F.lead(F.struct("first.status", "first.timestamp")).over(by_hour).alias("next"))
    pairs = inside.unionByName(between).where(F.col("next").isNotNull())
    return pairs.select("machine_id", *order, "temperature_c", F.col("next.status").alias("next_status"),
                        F.col("next.timestamp").alias("next_timestamp"))


def overheating_before_shutdown(telemetry: DataFrame) -> DataFrame:
    """Per machine, the first reading above 85 °C whose next reading (by
    time, then event id) has status idle, off or error."""
    pairs = next_readings(telemetry).where((F.col("temperature_c") > C.OVERHEAT_TEMP_C) & F.col("next_status").isin(*C.SHUTDOWN_STATUSES))
    first = pairs.groupBy("machine_id").agg(
        F.min(F.struct("timestamp", "event_id", "temperature_c", "next_status", "next_timestamp")).alias("p"))
    return first.select(
        "machine_id",
        F.round("p.temperature_c", 1).alias("hot_event_temp"),
        F.col("p.timestamp").alias("hot_event_time"),
        F.col("p.next_status").alias("next_status"),
        F.col("p.next_timestamp").alias("next_time"),
    )


def frequently_failing_machines(maintenance_fact: DataFrame, n: int = C.TOP_N) -> DataFrame:
    """Top ``n`` machines by number of maintenance events (ties by id)."""
    agg = maintenance_fact.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("maintenance_events"),
        F.sum(F.coalesce(F.col("downtime_minutes"), F.lit(0))).alias("total_downtime_min"),
    )
    return agg.orderBy(F.col("maintenance_events").desc(), F.col("machine_id").asc_nulls_first()).limit(n)


def downtime_by_factory(factory_metrics: DataFrame) -> DataFrame:
    return factory_metrics.select(
        "factory_id",
        "total_downtime_minutes",
        F.round("avg_downtime_minutes", 1).alias("avg_downtime_minutes"),
        F.col("downtime_event_count").alias("downtime_events"),
    ).orderBy(F.col("total_downtime_minutes").desc(), F.col("factory_id").asc_nulls_first())


def maintenance_reducing_downtime(effectiveness: DataFrame) -> DataFrame:
    return effectiveness.select(
        "maintenance_type",
        F.round("avg_downtime_minutes", 1).alias("avg_downtime_minutes"),
        "total_downtime_minutes",
        "event_count",
    ).orderBy(F.col("avg_downtime_minutes").asc(), F.col("maintenance_type").asc_nulls_first())


def machines_high_scrap(scrap: DataFrame) -> DataFrame:
    """All machines by scrap rate (the reference applies no threshold here)."""
    return scrap.select(
        "machine_id",
        F.round("scrap_rate", 4).alias("scrap_rate"),
        "total_scrap_units",
        "total_units_produced",
    ).orderBy(F.col("scrap_rate").desc(), F.col("machine_id").asc_nulls_first())


def lines_abnormal_variability(production: DataFrame) -> DataFrame:
    """Per machine: mean, population std and coefficient of variation of
    units produced; machines with fewer than 2 rows or mean 0 are dropped.

    Moments are exact: count, sum and sum of squares of the integer units
    (as decimal(38,0), so they cannot overflow), combined in double only at
    the end. ``abnormal`` compares the unrounded cv.
    """
    units = F.col("units_produced").cast("decimal(38,0)")
    agg = production.groupBy("machine_id").agg(
        F.count("units_produced").alias("n"),
        F.sum(units).alias("s1"),
        F.sum(units * units).alias("s2"),
    )
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    mean = s1.cast("double") / n.cast("double")
    var = (n.cast("decimal(38,0)") * s2 - s1 * s1).cast("double") / (n.cast("double") * n.cast("double"))
    std = F.sqrt(var)
    cv = std / mean
    out = agg.where((n >= 2) & (s1 != 0)).select(
        "machine_id",
        F.round(mean, 1).alias("mean_units"),
        F.round(std, 1).alias("std_units"),
        F.round(cv, 4).alias("cv"),
        n.alias("data_points"),
        (cv > C.CV_ABNORMAL).alias("abnormal"),
    )
    return out.orderBy(F.col("cv").desc(), F.col("machine_id").asc_nulls_first())
