"""Declared schemas. Ingest never infers: columns are taken by name, a missing
column is null and an unknown one is dropped."""

from pyspark.sql import types as T

RAW_TELEMETRY = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("factory_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("vibration_mm_s", T.DoubleType()),
    T.StructField("power_kw", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

RAW_MACHINES = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("factory_id", T.StringType()),
    T.StructField("machine_type", T.StringType()),
    T.StructField("install_date", T.StringType()),
    T.StructField("status", T.StringType()),
])

RAW_MAINTENANCE = T.StructType([
    T.StructField("maintenance_id", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("maintenance_type", T.StringType()),
    T.StructField("part_replaced", T.StringType()),
    T.StructField("downtime_minutes", T.LongType()),
])

RAW_PRODUCTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("shift", T.StringType()),
    T.StructField("units_produced", T.LongType()),
    T.StructField("scrap_units", T.LongType()),
    T.StructField("operator_id", T.StringType()),
])

# Columns written at ingest that record scan order, so that keep-last dedup
# does not depend on file listing order.
SCAN_ORDER_COLUMNS = ("_batch_id", "_src_mtime", "_src_file", "_src_offset", "_row_seq")

QUALITY_RESULT = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("details", T.StringType(), False),
    T.StructField("records_checked", T.LongType(), False),
    T.StructField("records_failed", T.LongType(), False),
])

ALERT = T.StructType([
    T.StructField("alert_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("item_count", T.LongType(), False),
])

RUN_RECORD = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("step", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

LINEAGE_RECORD = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("step", T.StringType()),
    T.StructField("inputs", T.ArrayType(T.StringType())),
    T.StructField("outputs", T.ArrayType(T.StringType())),
    T.StructField("input_rows", T.LongType()),
    T.StructField("output_rows", T.LongType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# High-water marks: one row per source.
WATERMARK_STATE = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("mark", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
