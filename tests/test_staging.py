import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows, ts
from forgeline.operators import staging as ST


def test_normalize_lowercases_and_strips_spaces_only(spark):
    df = spark.createDataFrame([(" Ab ",), ("\tAb",), (None,)], "s string")
    out = ST.normalize_strings(df, ["s", "absent"])
    assert rows(out) == [(None,), ("\tab",), ("ab",)]


def test_keep_last_by_hour_batch_row(spark):
    df = spark.createDataFrame([
        ("k1", 1, 10, "b1", 0, "old"),
        ("k1", 1, 10, "b2", 0, "new"),        # later batch wins
        ("k2", 1, 11, "b1", 0, "later-hour"),  # later hour wins over later batch
        ("k2", 1, 10, "b9", 0, "early-hour"),
        ("k3", 1, 10, "b1", 1, "row1"),
        ("k3", 1, 10, "b1", 2, "row2"),        # later row in the same batch wins
        (None, 1, 10, "b1", 0, "null-a"),
        (None, 1, 10, "b1", 5, "null-b"),      # null keys are one group
    ], "k string, day int, hour int, _batch_id string, _row_seq long, v string")
    out = ST.keep_last(df, "k")
    assert rows(out, "k", "v") == [(None, "null-b"), ("k1", "new"), ("k2", "later-hour"), ("k3", "row2")]


def test_keep_last_needs_order(spark):
    with pytest.raises(ValueError):
        ST.keep_last(spark.createDataFrame([("a",)], "k string"), "k")


def test_keep_last_plans_partial_group_limit(spark):
    df = spark.createDataFrame([("a", "b1", 1)], "k string, _batch_id string, _row_seq long")
    plan = ST.keep_last(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_cast_timestamp_strict(spark):
    good = spark.createDataFrame([("2026-03-01T04:05:06",), (None,)], "timestamp string")
    assert rows(ST.cast_timestamp(good, "timestamp")) == [(None,), (ts("2026-03-01T04:05:06"),)]
    for bad in ("2026-03-01T04:05:06.123", "2026-03-01T04:05:06Z", "2026-03-01 04:05:06"):
        df = spark.createDataFrame([(bad,)], "timestamp string")
        with pytest.raises(PySparkException):
            ST.cast_timestamp(df, "timestamp").collect()


def test_cast_date(spark):
    df = spark.createDataFrame([("2026-03-01",)], "date string")
    assert ST.cast_date(df, "date").first()[0].isoformat() == "2026-03-01"


def test_clamp_non_negative_null_is_zero(spark):
    df = spark.createDataFrame([(-3,), (0,), (5,), (None,)], "x long")
    assert sorted(r[0] for r in ST.clamp_columns(df, ["x"]).collect()) == [0, 0, 0, 5]


def _raw_telemetry(spark, data):
    schema = ("event_id string, machine_id string, factory_id string, timestamp string, "
              "temperature_c double, vibration_mm_s double, power_kw double, status string, "
              "hour int, _batch_id string, _row_seq long")
    return spark.createDataFrame(data, schema)


def test_stage_telemetry_pipeline(spark):
    raw = _raw_telemetry(spark, [
        ("evt_1", " M1 ", "F1", "2026-03-01T04:00:00", 80.0, 1.0, 2.0, "Idle", 4, "b1", 0),
        ("evt_1", "m1", "f1", "2026-03-01T04:00:00", 81.0, 1.0, 2.0, "OFF", 4, "b2", 0),
        ("evt_2", "m2", "f1", "2026-03-01T05:00:00", 70.0, 1.0, 2.0, "running", 5, "b1", 1),
    ])
    out = ST.stage_telemetry(raw)
    assert out.columns == ST.TELEMETRY_COLUMNS
    assert rows(out, "event_id", "machine_id", "temperature_c", "status") == [
        ("evt_1", "m1", 81.0, "off"), ("evt_2", "m2", 70.0, "running")]


def test_stage_production_no_dedup_and_clamp(spark):
    raw = spark.createDataFrame([
        ("2026-03-01", " M1", "A", 10, -1, "OP1"),
        ("2026-03-01", " M1", "A", 10, -1, "OP1"),
    ], "date string, machine_id string, shift string, units_produced long, scrap_units long, operator_id string")
    out = ST.stage_production(raw)
    assert out.count() == 2
    assert rows(out, "machine_id", "shift", "scrap_units", "operator_id")[0] == ("m1", "a", 0, "op1")
    assert dict(out.dtypes)["date"] == "date"


def test_stage_machines_newest_snapshot_and_missing_machine_stays(spark):
    raw = spark.createDataFrame([
        ("M1", "F1", "Assembly", "2020-01-01", "active", "s1", 0),
        ("M2", "F1", "Assembly", "2020-01-01", "active", "s1", 1),
        ("M1", "F2", "Assembly", "2020-01-01", "maintenance", "s2", 0),
    ], "machine_id string, factory_id string, machine_type string, install_date string, status string, "
       "_batch_id string, _row_seq long")
    out = ST.stage_machines(raw)
    assert rows(out, "machine_id", "factory_id", "status") == [("m1", "f2", "maintenance"), ("m2", "f1", "active")]


def test_stage_maintenance_none_text_kept(spark):
    raw = spark.createDataFrame([
        ("mnt_1", "M1", "2026-03-01T00:00:00", "Inspection", "none", -5, "b1", 0),
    ], "maintenance_id string, machine_id string, timestamp string, maintenance_type string, "
       "part_replaced string, downtime_minutes long, _batch_id string, _row_seq long")
    r = ST.stage_maintenance(raw).first()
    assert (r.part_replaced, r.downtime_minutes, r.maintenance_type) == ("none", 0, "inspection")


def test_late_correction_with_earlier_hour_loses(spark):
    # order is (event-hour partition, batch, ...): a later batch re-sending
    # the event under an earlier hour does not replace it (reference parity)
    df = spark.createDataFrame([
        ("k", 1, 5, "b1", 0, "original hour 5"),
        ("k", 1, 4, "b2", 0, "later batch, hour 4"),
    ], "k string, day int, hour int, _batch_id string, _row_seq long, v string")
    assert ST.keep_last(df, "k").first().v == "original hour 5"
