import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forgeline import jobs as J
from forgeline.sinks.files import overwrite_table
from forgeline.sources import testbind as TB
from forgeline.sources.files import read_or_none

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2024, 1, 31)


def seed_sources(spark, tmp_path):
    """Source files as the reference receives them: CSV for machines,
    maintenance and production, JSON lines for telemetry (two deliveries)."""
    src, landing = str(tmp_path / "src"), tmp_path / "landing"
    drop = ["year", "month", "day", "hour", "_batch_id", "_row_seq"]
    TB.raw_machines(spark, SF).drop(*drop).write.option("header", True).csv(f"{src}/machines.csv")
    TB.raw_maintenance(spark, SF).drop(*drop).write.option("header", True).csv(f"{src}/maintenance_logs.csv")
    TB.raw_production(spark, SF).write.option("header", True).csv(f"{src}/daily_production.csv")
    tel = TB.raw_telemetry(spark, SF)
    return src, landing, tel.where(F.col("_batch_id") == "0").drop(*drop), tel.where(F.col("_batch_id") == "1").drop(*drop)


def deliver(df, staging_dir, landing):
    """Files appear in the landing folder whole (written elsewhere, then moved)."""
    import glob
    import os
    import shutil

    df.write.json(str(staging_dir))
    os.makedirs(landing, exist_ok=True)
    for f in glob.glob(f"{staging_dir}/part-*.json"):
        shutil.move(f, os.path.join(landing, f"{staging_dir.name}-{os.path.basename(f)}"))


def test_full_run_matches_in_memory_queries(spark, lake, tmp_path):
    import __spark_entry__ as E

    src, landing, first, resent = seed_sources(spark, tmp_path)
    deliver(first, tmp_path / "d0", landing)
    failed = J.run_all(spark, lake, src, str(landing), AS_OF, steps=["ingest"])
    assert failed == []
    # the re-sent delivery arrives later in the same landing folder: the
    # restarted stream takes only it, in a later micro-batch, so it wins
    deliver(resent, tmp_path / "d1", landing)
    from forgeline.streaming.telemetry import ingest_telemetry
    assert ingest_telemetry(spark, lake, str(landing))["total_events"] == resent.count()
    failed = J.run_all(spark, lake, src, str(landing), AS_OF,
                       steps=["staging", "analytics", "quality", "alerts", "queries"])
    assert failed == []

    analytics = J.run_analytics(spark, lake)["tables"]
    assert len(analytics) == 8
    staged = read_or_none(spark, lake.staging("telemetry"))
    assert staged.count() == E.queries()["stage_telemetry"](spark, SF).count()
    serving = J.run_serving(spark, lake, AS_OF)
    for name in ["telemetry_status", "dashboard_silent", "dashboard_high_scrap", "dashboard_downtime", "dashboard_abnormal"]:
        assert serving[name] == E.queries()[name](spark, SF).count(), name
        want = E.queries()[name](spark, SF)
        cols = [c for c in want.columns if not c.startswith("avg_")]
        assert rows(read_or_none(spark, lake.path("serving", name)), *cols) == rows(want, *cols), name
    for name in ["downtime_by_factory", "machines_high_scrap", "lines_abnormal_variability",
                 "maintenance_reducing_downtime", "frequently_failing_machines"]:
        lake_rows = read_or_none(spark, lake.path("serving", name))
        assert rows(lake_rows) == rows(E.queries()[name](spark, SF)), name
    report = J.run_quality(spark, lake, fail_early=False)
    assert [r["check_name"] for r in report] == ["missing_telemetry", "negative_production",
                                                 "machine_id_mismatch", "null_critical_fields"]
    assert read_or_none(spark, lake.alert_report, "json") is not None
    extract = read_or_none(spark, lake.path("serving", "extracts", "machine_health_features"), "json")
    assert extract.count() == read_or_none(spark, lake.analytics("machine_health_features")).count()
    hist = J.run_history(spark, lake)
    assert {"ingestion.telemetry", "transformations.staging", "warehouse.queries"} <= {
        r.step for r in hist.collect()}
    assert J.lineage(spark, lake).count() >= 12


def test_a_recorded_block_leaves_one_record(spark, lake):
    with J.recorded(spark, lake, "copy.machines") as run:
        run.done(3)
        run.done(5)
    with pytest.raises(ZeroDivisionError):
        with J.recorded(spark, lake, "copy.logs") as run:
            run.done(9)
            1 / 0
    by_step = {r.step: r for r in J.run_history(spark, lake).collect()}
    assert {s: (r.status, r.rows, r.error) for s, r in by_step.items()} == {
        "copy.machines": ("success", 8, None), "copy.logs": ("failure", 0, "division by zero")}
    assert all(r.duration_seconds >= 0 for r in by_step.values())
    assert [r.step for r in J.run_history(spark, lake, step="copy.logs").collect()] == ["copy.logs"]


def test_failed_runs_are_those_of_the_last_hours(spark, lake):
    for hours, status in ((1, "failure"), (30, "failure"), (2, "success")):
        J.record_run(spark, lake, f"old.{hours}", status=status, at=AS_OF - dt.timedelta(hours=hours), metadata={"k": [1, 2]})
    found = J.failed_runs(spark, lake, AS_OF).collect()
    assert [(r.step, r.metadata) for r in found] == [("old.1", {"k": "[1, 2]"})]


def test_tasks_come_after_what_they_read(spark, lake):
    order = [t.name for t in J.in_order(J.tasks_of(spark, lake, "src", "landing", AS_OF))]
    assert set(order[:3]) == {"ingestion.telemetry", "ingestion.maintenance", "ingestion.production"}
    assert order[3:5] == ["transformations.staging", "transformations.analytics"]
    assert order.index("quality.checks") < order.index("monitoring.alerts") < order.index("serving.status")


def test_report_ends_with_the_check_that_failed(spark, lake):
    overwrite_table(spark.createDataFrame([(dt.date(2026, 3, 1), "m1", -4, 0)], "date date, machine_id string, units_produced long, scrap_units long"),
                    lake.staging("production"))
    overwrite_table(spark.createDataFrame([("evt_1", "m1", AS_OF), ("evt_2", "m1", AS_OF)], "event_id string, machine_id string, timestamp timestamp_ntz"),
                    lake.staging("telemetry"))
    with pytest.raises(J.QualityCheckError, match="negative_production"):
        J.run_quality(spark, lake)
    assert [r.check_name for r in read_or_none(spark, lake.quality_report, "json").collect()] == ["missing_telemetry", "negative_production"]
    assert len(J.run_quality(spark, lake, fail_early=False)) == 4


def test_dashboard_without_telemetry(spark, lake):
    assert J.run_serving(spark, lake, AS_OF) == {"dashboard_kpis": 1}
    overwrite_table(spark.createDataFrame([("m2",), ("m1",)], "machine_id string"), lake.staging("machines"))
    out = J.run_serving(spark, lake, AS_OF)
    assert (out["telemetry_status"], out["dashboard_silent"]) == (2, 2)
    status = read_or_none(spark, lake.path("serving", "telemetry_status"))
    assert rows(status) == [("m1", None, None, "no_data"), ("m2", None, None, "no_data")]
    kpis = read_or_none(spark, lake.path("serving", "dashboard_kpis")).first().asDict()
    assert kpis == {"factories": 0, "machines": 0, "abnormal": 0, "silent": 2, "high_scrap": 0, "alerts": 0}


def test_lineage_round_trip(spark, lake):
    J.record_lineage(spark, lake, "example", ["raw/telemetry"], ["staging/telemetry"], 500, 500)
    e = J.lineage(spark, lake).first()
    assert (e.step, e.inputs, e.outputs, e.input_rows) == ("example", ["raw/telemetry"], ["staging/telemetry"], 500)


def test_run_all_goes_on_after_a_failed_task(spark, lake, tmp_path):
    # no production file: that ingest task fails (as in the reference), the
    # others run and every task is recorded
    failed = J.run_all(spark, lake, str(tmp_path / "empty"), str(tmp_path / "landing"), AS_OF,
                       steps=["ingest", "staging"])
    assert "ingestion.production" in failed
    steps = {(r.step, r.status) for r in J.run_history(spark, lake).collect()}
    assert ("ingestion.production", "failure") in steps
    assert ("transformations.staging", "success") in steps
