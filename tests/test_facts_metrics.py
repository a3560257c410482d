import math

from conftest import rows, ts
from forgeline.operators import facts as FT
from forgeline.operators import metrics as M


def machines(spark):
    return spark.createDataFrame([("m1", "f1", "press"), ("m2", "f2", "lathe")],
                                 "machine_id string, factory_id string, machine_type string")


def test_left_lookup_keeps_unknown_and_null(spark):
    prod = spark.createDataFrame([
        (None, "m1", 10, 1), (None, "zz", 0, 3), (None, None, 4, 1)],
        "date date, machine_id string, units_produced long, scrap_units long")
    out = FT.fact_production(prod, machines(spark))
    assert rows(out, "machine_id", "factory_id", "scrap_rate") == [
        (None, None, 0.25), ("m1", "f1", 0.1), ("zz", None, 3.0)]


def test_fact_downtime_filters_positive(spark):
    maint = spark.createDataFrame([("a", "m1", 0), ("b", "m1", 5), ("c", "zz", 7)],
                                  "maintenance_id string, machine_id string, downtime_minutes long")
    out = FT.fact_downtime(maint, machines(spark))
    assert rows(out, "maintenance_id", "factory_id") == [("b", "f1"), ("c", None)]


def test_fact_machine_events_type_only(spark):
    tel = spark.createDataFrame([("e1", "m2", "fx")], "event_id string, machine_id string, factory_id string")
    r = FT.fact_machine_events(tel, machines(spark)).first()
    assert (r.factory_id, r.machine_type) == ("fx", "lathe")


def test_health_nulls_nan_and_counts(spark):
    tel = spark.createDataFrame([
        ("e1", "m1", 80.0, 1.0, 2.0),
        ("e2", "m1", 90.0, 3.0, 4.0),
        (None, "m1", None, None, None),
        ("e3", "m2", None, None, None),
        ("e4", "m3", float("nan"), 1.0, 1.0),
        ("e5", "m3", 70.0, 1.0, 1.0),
    ], "event_id string, machine_id string, temperature_c double, vibration_mm_s double, power_kw double")
    out = {r.machine_id: r for r in M.machine_health_features(tel).collect()}
    assert out["m1"].avg_temperature_c == 85.0 and out["m1"].max_temperature_c == 90.0
    assert out["m1"].event_count == 2
    assert out["m2"].avg_temperature_c is None and out["m2"].max_temperature_c is None
    assert math.isnan(out["m3"].avg_temperature_c) and out["m3"].max_temperature_c == 70.0


def test_factory_downtime_empty_and_null_factory(spark):
    empty = spark.createDataFrame([], "factory_id string, downtime_minutes long")
    assert M.factory_downtime_metrics(empty).count() == 0
    df = spark.createDataFrame([(None, 5), (None, 7), ("f1", 1)], "factory_id string, downtime_minutes long")
    out = rows(M.factory_downtime_metrics(df))
    assert out == [(None, 12, 6.0, 2, 7), ("f1", 1, 1.0, 1, 1)]


def test_scrap_rate_zero_units(spark):
    df = spark.createDataFrame([("m1", 0, 3)], "machine_id string, units_produced long, scrap_units long")
    assert M.scrap_rate_metrics(df).first().scrap_rate == 3.0


def test_group_by_agg_renames(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, x long")
    out = M.group_by_agg(df, "g", [("x", "sum", "total"), ("x", "mean", "avg_x")])
    assert rows(out) == [("a", 4, 2.0), ("b", 5, 5.0)]


def test_latest_event(spark):
    df = spark.createDataFrame([("m1", ts("2026-01-01T00:00:00")), ("m1", ts("2026-01-02T00:00:00"))],
                               "machine_id string, timestamp timestamp_ntz")
    assert M.latest_event_per_machine(df).first().last_event == ts("2026-01-02T00:00:00")
