import datetime as dt

from conftest import rows, ts
from forgeline.operators import alerts as A
from forgeline.operators import serving as S

AS_OF = dt.datetime(2026, 3, 2, 12, 0, 0)


def test_silence_exactly_one_hour_is_not_silent(spark):
    tel = spark.createDataFrame([("m1", ts("2026-03-02T11:00:00")), ("m2", ts("2026-03-02T10:00:00"))],
                                "machine_id string, timestamp timestamp_ntz")
    mach = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "machine_id string")
    items = A.telemetry_silence_items(tel, mach, AS_OF)
    assert rows(items) == [("m2", ts("2026-03-02T10:00:00"), 2.0), ("m3", None, None)]
    h = A.telemetry_silence_alert(items).first()
    assert (h.severity, h.message, h.item_count) == ("warning", "2 machine(s) have not sent telemetry in 1.0h", 2)
    status = {r.machine_id: r.status for r in S.telemetry_status(tel, mach, AS_OF).collect()}
    assert status == {"m1": "active", "m2": "silent", "m3": "no_data"}


def test_temperature_severity_uses_rounded_max(spark):
    def health(mx):
        return spark.createDataFrame([("m1", 80.0, mx)], "machine_id string, avg_temperature_c double, "
                                                         "max_temperature_c double")
    assert A.temperature_alert(A.temperature_items(health(95.04))).first().severity == "warning"
    h = A.temperature_alert(A.temperature_items(health(95.06))).first()
    assert h.severity == "critical" and h.message == "1 machine(s) exceeded 85.0°C temperature threshold"
    assert A.temperature_alert(A.temperature_items(health(80.0))).count() == 0


def test_scrap_alert(spark):
    scrap = spark.createDataFrame([("m1", 100, 6, 0.06), ("m2", 100, 5, 0.05)],
                                  "machine_id string, total_units_produced long, total_scrap_units long, "
                                  "scrap_rate double")
    h = A.scrap_alert(A.scrap_items(scrap)).first()
    assert h.message == "1 machine(s) exceed 5% scrap rate threshold"


def test_late_data(spark):
    def state(prod_mark):
        return spark.createDataFrame([("maintenance_logs", "2026-03-02T09:00:00"), ("production", prod_mark)],
                                     "source string, mark string")
    got = {(r.source, r.severity) for r in A.late_data_alerts(state("2026-03-02"), AS_OF).collect()}
    assert got == {("maintenance", "warning")}
    r = [r for r in A.late_data_alerts(state("2026-03-01"), AS_OF).collect() if r.source == "production"][0]
    assert (r.severity, r.message) == ("info", "Production data is 1 day(s) behind")
    r = [r for r in A.late_data_alerts(state("2026-02-28"), AS_OF).collect() if r.source == "production"][0]
    assert r.severity == "warning"
    m = [r for r in A.late_data_alerts(state("2026-03-02"), AS_OF).collect()][0]
    assert m.message == "Maintenance data is 3.0h old (threshold: 2.0h)"


def test_failed_runs_window_and_summary(spark):
    hist = spark.createDataFrame([
        (ts("2026-03-01T12:00:00"), "a", "failure"),   # exactly 24 h ago: included
        (ts("2026-03-01T11:59:59"), "b", "failure"),
        (ts("2026-03-02T11:00:00"), "c", "success"),
    ], "timestamp timestamp_ntz, step string, status string")
    items = A.failed_run_items(hist, AS_OF)
    assert [r.step for r in items.collect()] == ["a"]
    header = A.pipeline_failure_alert(items)
    report = A.alert_report([header])
    s = A.alert_summary(report).first()
    assert (s.total_alerts, s.critical, s.warnings) == (1, 1, 0)
