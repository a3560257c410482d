import json
import os
import shutil

import pytest

from forgeline import ingest as I
from forgeline.jobs import run_staging
from forgeline.sources.files import read_or_none, read_raw_parquet
from forgeline.streaming.telemetry import ingest_telemetry


def write_csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_csv_by_name_and_high_water_marks(spark, lake, tmp_path):
    src = str(tmp_path / "src")
    write_csv(f"{src}/machines.csv", "status,machine_id,factory_id,machine_type,install_date,extra",
              ["active,mach_001,fac_01,assembly,2024-01-01,x"])
    write_csv(f"{src}/maintenance_logs.csv",
              "maintenance_id,machine_id,timestamp,maintenance_type,part_replaced,downtime_minutes",
              ["mnt_1,mach_001,2026-03-01T00:00:00,inspection,none,10",
               "mnt_2,mach_001,2026-03-02T00:00:00,calibration,sensor,0"])
    s1 = I.ingest_maintenance(spark, lake, src, batch_id="20260302T000000")
    assert (s1["machines_rows"], s1["maintenance_logs_rows"], s1["watermark"]) == (1, 2, "2026-03-02T00:00:00")
    m = read_raw_parquet(spark, lake.raw_machines).first()
    assert (m.machine_id, m.status) == ("mach_001", "active")  # by name, extra dropped
    assert "extra" not in read_raw_parquet(spark, lake.raw_machines).columns

    # row at the mark and row below are not taken again; a new row is
    write_csv(f"{src}/maintenance_logs.csv",
              "maintenance_id,machine_id,timestamp,maintenance_type,part_replaced,downtime_minutes",
              ["mnt_2,mach_001,2026-03-02T00:00:00,calibration,sensor,0",
               "mnt_0,mach_001,2026-02-01T00:00:00,late,none,1",
               "mnt_3,mach_001,2026-04-01T00:00:00,inspection,none,5"])
    s2 = I.ingest_maintenance(spark, lake, src, batch_id="20260402T000000")
    assert (s2["maintenance_logs_rows"], s2["watermark"]) == (1, "2026-04-01T00:00:00")
    s3 = I.ingest_maintenance(spark, lake, src, batch_id="20260403T000000")
    assert (s3["maintenance_logs_rows"], s3["watermark"]) == (0, "2026-04-01T00:00:00")
    raw = read_raw_parquet(spark, lake.raw_maintenance)
    assert sorted(r.maintenance_id for r in raw.collect()) == ["mnt_1", "mnt_2", "mnt_3"]
    assert {"year", "month", "_batch_id"} <= set(raw.columns)

    # retrying a batch replaces its own partitions instead of duplicating
    I.ingest_production  # noqa: B018
    write_csv(f"{src}/daily_production.csv", "date,machine_id,shift,units_produced,scrap_units,operator_id",
              ["2026-03-01,mach_001,A,10,1,op_1", "2026-03-02,mach_001,B,12,-1,op_2"])
    p1 = I.ingest_production(spark, lake, f"{src}/daily_production.csv", batch_id="b1")
    assert I.load_marks(spark, lake) == {"maintenance_logs": "2026-04-01T00:00:00", "production": "2026-03-02"}
    assert p1["rows"] == 2
    # simulate a crash before the mark was saved: same batch again
    shutil.rmtree(lake.state.replace("file:", "") + "/source=production")
    I.ingest_production(spark, lake, f"{src}/daily_production.csv", batch_id="b1")
    assert read_raw_parquet(spark, lake.raw_production).count() == 2
    assert I.ingest_production(spark, lake, f"{src}/daily_production.csv", batch_id="b2")["rows"] == 0


def test_missing_machines_file_is_skipped(spark, lake, tmp_path):
    assert I.ingest_machines(spark, lake, str(tmp_path / "nothing"), "b") == 0


def _events(n, hour, start):
    return [json.dumps({"event_id": f"evt_{start + i:06d}", "machine_id": "M1", "factory_id": "f1",
                        "timestamp": f"2026-03-01T{hour:02d}:{i % 60:02d}:00", "temperature_c": 70.0 + i,
                        "vibration_mm_s": 1.0, "power_kw": 2.0, "status": "running", "junk": 1})
            for i in range(n)]


def test_stream_lands_every_event_restart_and_duplicates(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for k in range(3):  # 120 events of one hour over three files
        (landing / f"part{k}.jsonl").write_text("\n".join(_events(40, 4, 40 * k)) + "\n\n")
    s1 = ingest_telemetry(spark, lake, str(landing), max_files_per_trigger=1)
    assert (s1["total_events"], s1["total_batches"]) == (120, 3)
    assert s1["total_partitions_written"] == 3 and s1["batch_id"].startswith("e000000000002-")  # one hour per batch
    assert read_raw_parquet(spark, lake.raw_telemetry).count() == 120

    s2 = ingest_telemetry(spark, lake, str(landing))  # restart: nothing new
    assert s2["total_events"] == 0

    # the same file delivered again under a new name: landed again, removed by keep-last
    shutil.copy(landing / "part0.jsonl", landing / "part0-copy.jsonl")
    assert ingest_telemetry(spark, lake, str(landing))["total_events"] == 40
    raw = read_raw_parquet(spark, lake.raw_telemetry)
    assert raw.count() == 160 and "junk" not in raw.columns
    stats = run_staging(spark, lake)
    assert stats["telemetry"] == 120


def test_stream_counts_more_batches_than_progress_keeps(spark, lake, tmp_path):
    landing = tmp_path / "many"
    landing.mkdir()
    for k in range(6):
        (landing / f"part{k}.jsonl").write_text(_events(1, 4, k)[0] + "\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        got = ingest_telemetry(spark, lake, str(landing), max_files_per_trigger=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (got["total_events"], got["total_batches"]) == (6, 6)


def test_batch_stopped_before_its_mark_is_replaced(spark, lake, tmp_path, monkeypatch):
    src = str(tmp_path / "src")
    os.makedirs(src)
    head = "date,machine_id,shift,units_produced,scrap_units,operator_id"
    write_csv(f"{src}/p.csv", head, ["2026-03-01,m1,A,10,1,o1", "2026-04-02,m1,B,12,1,o2"])

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(I, "save_mark", stop)
        with pytest.raises(RuntimeError):
            I.ingest_production(spark, lake, f"{src}/p.csv")
    assert I.ingest_production(spark, lake, f"{src}/p.csv")["rows"] == 2
    assert read_raw_parquet(spark, lake.raw_production).count() == 2
    write_csv(f"{src}/p.csv", head, ["2026-04-02,m1,B,12,1,o2", "2026-04-03,m1,B,7,0,o2"])
    assert I.ingest_production(spark, lake, f"{src}/p.csv") == {
        "rows": 1, "watermark": "2026-04-03", "batch_id": "after-2026-04-02"}
    assert read_raw_parquet(spark, lake.raw_production).count() == 3
    assert I.load_marks(spark, lake) == {"production": "2026-04-03"}


def test_later_file_wins_whatever_its_name(spark, lake, tmp_path):
    landing = tmp_path / "order"
    landing.mkdir()
    event = json.loads(_events(1, 4, 0)[0])
    for name, value, at in (("events-9.json", 50.0, 1_000_000), ("events-10.json", 99.0, 1_000_060)):
        (landing / name).write_text(json.dumps({**event, "temperature_c": value}) + "\n")
        os.utime(landing / name, (at, at))
    ingest_telemetry(spark, lake, str(landing))
    run_staging(spark, lake)
    assert [r.temperature_c for r in read_or_none(spark, lake.staging("telemetry")).collect()] == [99.0]


def test_a_batch_has_one_file_an_hour_whatever_its_tasks(spark, lake, tmp_path):
    import glob

    from pyspark.sql import functions as F

    from forgeline.sinks.files import write_batch_partitions
    df = spark.range(4000).select((F.col("id") % 5).alias("hour"), F.lit("b1").alias("_batch_id"), "id").repartition(16)
    seen = write_batch_partitions(df, str(tmp_path / "raw"), ["hour", "_batch_id"], metrics=[F.count(F.lit(1)).alias("rows")])
    assert seen["rows"] == 4000
    assert len(glob.glob(f"{tmp_path}/raw/hour=*/_batch_id=b1/*.parquet")) == 5
    # a hot hour is cut into files of a stated size
    hot = spark.range(4000).select(F.lit(1).alias("hour"), F.lit("b2").alias("_batch_id"), "id").repartition(16)
    write_batch_partitions(hot, str(tmp_path / "raw"), ["hour", "_batch_id"], max_records_per_file=1000)
    assert len(glob.glob(f"{tmp_path}/raw/hour=1/_batch_id=b2/*.parquet")) == 4
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 8000
    assert write_batch_partitions(df.where("id < 0"), str(tmp_path / "raw"), ["hour", "_batch_id"], metrics=[F.count(F.lit(1)).alias("rows")]).get("rows", 0) == 0


def test_a_month_that_a_rerun_no_longer_has_goes(spark, lake, tmp_path, monkeypatch):
    """Only the stopped batch's own partitions: other batches of that month stay, and so does a given batch id."""
    src, head = str(tmp_path / "p.csv"), "date,machine_id,shift,units_produced,scrap_units,operator_id"

    def source(*dates):
        write_csv(src, head, [f"{d},m1,day,5,1,o" for d in dates])

    def dates():
        raw = read_raw_parquet(spark, lake.raw_production)
        return sorted(r["date"] for r in raw.collect())

    source("2026-01-05")
    I.ingest_production(spark, lake, src)
    source("2026-01-05", "2026-01-20", "2026-02-01", "")

    def stop(*_):
        raise RuntimeError("stop")

    with monkeypatch.context() as m:
        m.setattr(I, "save_mark", stop)
        with pytest.raises(RuntimeError):
            I.ingest_production(spark, lake, src)
    assert dates() == ["2026-01-05", "2026-01-20", "2026-02-01"]
    source("2026-01-05", "2026-02-02")  # the source was corrected
    assert I.ingest_production(spark, lake, src)["rows"] == 1
    assert dates() == ["2026-01-05", "2026-02-02"]
    source("2026-03-01")
    I.ingest_production(spark, lake, src, batch_id="given")
    source("2026-04-01")
    I.ingest_production(spark, lake, src, batch_id="given")
    assert dates() == ["2026-01-05", "2026-02-02", "2026-03-01", "2026-04-01"]
