"""Checks the reference declares in its documents and DDL but never runs in
code (row-count thresholds, missing event windows, health flags, enum,
primary-key, foreign-key and NOT NULL / DEFAULT rules). Labelled as
extensions; they follow the declared intent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline import config as C
from forgeline.operators import bloom
from forgeline.operators.quality import null_counts
from forgeline.plans.joins import broadcast_limit, fits_broadcast, lookup_join

# Enum values seen in the reference's machines sample file.
MACHINE_TYPES = ("packaging", "soldering", "inspection", "assembly")
MACHINE_STATUSES = ("active", "maintenance")

# NOT NULL columns and DEFAULTs of the reference's DDL.
PRIMARY_KEYS = {"machines": "machine_id", "maintenance_logs": "maintenance_id"}
NOT_NULL = {
    "machines": ["factory_id", "machine_type"],
    "maintenance_logs": ["machine_id", "timestamp", "maintenance_type"],
}
DEFAULTS = {
    "machines": {"status": "active"},
    "maintenance_logs": {"downtime_minutes": 0},
}


def row_count_threshold(tables: dict[str, DataFrame], minimums: dict[str, int]) -> DataFrame:
    parts = [tables[name].agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(int(lo)).cast("bigint").alias("min_rows"),
        (F.col("rows") >= lo).alias("passed")) for name, lo in minimums.items() if name in tables]
    return reduce(DataFrame.unionByName, parts)


def missing_event_windows(telemetry: DataFrame) -> DataFrame:
    """Per machine, each hour between its first and last event hour with no
    event (machine_id, missing_hour). Hours seen are a distinct (partially
    aggregated) set; the candidate hours come from one row per machine."""
    ts = F.col("timestamp")
    # hour bucket from the value's own fields (date_trunc would return a
    # zoned timestamp and depend on the session time zone)
    bucket = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    hours = telemetry.where(ts.isNotNull()).select("machine_id", bucket.alias("hour"))
    seen = hours.distinct()
    span = seen.groupBy("machine_id").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    every = span.select("machine_id", F.explode(
        F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    missing = every.join(seen, ["machine_id", "hour"], "left_anti")
    return missing.select("machine_id", F.col("hour").alias("missing_hour"))


def missing_event_gaps(telemetry: DataFrame) -> DataFrame:
    """The same as ranges: machine_id, first_hour, last_hour, hours of each run of
    hours without an event between two that have some. Rows grow with the gaps,
    not with their length; the window sees each machine's different hours."""
    ts = F.col("timestamp")
    first = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
    seen = telemetry.where(ts.isNotNull()).select("machine_id", first.alias("hour")).distinct()
    after = F.lead("hour").over(Window.partitionBy("machine_id").orderBy("hour"))
    gaps = seen.withColumn("after", after).withColumn("hours", F.timestamp_diff("HOUR", F.col("hour"), F.col("after")) - 1)
    one = F.expr("INTERVAL 1 HOUR")
    return gaps.where(F.col("hours") > 0).select("machine_id", (F.col("hour") + one).alias("first_hour"), (F.col("after") - one).alias("last_hour"), "hours")


def health_flags(machine_events: DataFrame, temp_c: float = C.TEMP_THRESHOLD_C,
                 critical_c: float = C.TEMP_CRITICAL_C,
                 vibration: float = C.TREND_AVG_VIBRATION) -> DataFrame:
    t, v = F.col("temperature_c"), F.col("vibration_mm_s")
    return machine_events.select(
        "event_id", "machine_id", "timestamp",
        F.when(t > critical_c, F.lit("critical")).when(t > temp_c, F.lit("warning"))
        .when(t.isNull(), F.lit("unknown")).otherwise(F.lit("normal")).alias("temperature_flag"),
        F.coalesce(v > vibration, F.lit(False)).alias("high_vibration"),
    )


def enum_validation(machines: DataFrame) -> DataFrame:
    """Rows per (column, value) whose value is outside the allowed set."""
    bad_type = machines.where(~F.coalesce(F.col("machine_type").isin(*MACHINE_TYPES), F.lit(False))) \
        .groupBy(F.col("machine_type").alias("value")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("machine_type").alias("column_name"), "value", "rows")
    bad_status = machines.where(~F.coalesce(F.col("status").isin(*MACHINE_STATUSES), F.lit(False))) \
        .groupBy(F.col("status").alias("value")).agg(F.count(F.lit(1)).alias("rows")) \
        .select(F.lit("status").alias("column_name"), "value", "rows")
    return bad_type.unionByName(bad_status)


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (key, rows)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def declared_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, key, rows) of the declared primary keys that are null or occur more than once."""
    parts = []
    for name, key in PRIMARY_KEYS.items():
        counted = tables[name].groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(counted.where((F.col("rows") > 1) | F.col("key").isNull()).select(F.lit(name).alias("table_name"), "key", "rows"))
    return reduce(DataFrame.unionByName, parts)


def fk_violations(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null ``key`` has no parent row. Where the parents
    are too many to broadcast, the children's different keys alone are joined to
    them, and of the child rows only those with a possible stranger's key are shuffled."""
    parents = parent.select(key).where(F.col(key).isNotNull()).distinct()
    known = child.where(F.col(key).isNotNull())
    if fits_broadcast(parents, broadcast_limit(parent), bound_by=parent):
        return lookup_join(known, parents, key, how="left_anti", bound_by=parent)
    strangers = known.select(key).distinct().join(parents, key, "left_anti")
    return bloom.rows_of(child, strangers, key)


def not_null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Nulls per NOT NULL column of the DDL."""
    return null_counts(tables, NOT_NULL).select("table_name", "column_name", "rows", "nulls")


def apply_defaults(df: DataFrame, table_name: str) -> DataFrame:
    """Fill the DDL DEFAULT of each column present."""
    fills = {c: v for c, v in DEFAULTS.get(table_name, {}).items() if c in df.columns}
    return df.fillna(fills) if fills else df
