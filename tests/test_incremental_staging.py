"""Versioned tables, the filter index and incremental staging against staging the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from forgeline import incremental as INC
from forgeline import jobs as J
from forgeline.operators import bloom
from forgeline.operators import metrics as M
from forgeline.operators import quality as Q
from forgeline.operators import staging as ST
from forgeline.plans.inspect import physical_plan
from forgeline.functions.time import time_partitions
from forgeline.sinks.files import overwrite_table, write_batch_partitions
from forgeline.sinks.versions import CommitConflict, VersionedTable
from forgeline.sources.files import read_or_none, read_raw_parquet
from forgeline.streaming.telemetry import PARTITIONS

TELEMETRY = ("event_id string, machine_id string, factory_id string, timestamp string, temperature_c double, vibration_mm_s double, "
             "power_kw double, status string")


# -- versioned tables --------------------------------------------------------------

def test_a_write_that_stops_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_table(spark.range(5), path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        overwrite_table(broken, path)
    assert read_or_none(spark, path).count() == 5
    overwrite_table(read_or_none(spark, path).union(spark.range(3)), path)  # a version may read the one before
    assert read_or_none(spark, path).count() == 8


def test_of_two_writers_from_one_version_the_second_fails(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    first = t.replace(spark.range(1))
    t.replace(spark.range(2))
    with pytest.raises(CommitConflict):
        t.commit({}, None, first)
    assert t.read().count() == 2 and t.current().number == 2


def test_old_versions_go_by_age_and_readers_keep_theirs_until_then(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.replace(spark.range(1))
    open_reader = t.read()
    t.replace(spark.range(2))
    assert t.vacuum(dt.timedelta(hours=1)) == [] and open_reader.count() == 1
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    assert len(t.vacuum(dt.timedelta(hours=1), now=later)) == 1
    assert t.read().count() == 2 and VersionedTable(spark, str(tmp_path / "none")).vacuum(dt.timedelta(0)) == []


def test_absent_and_empty_tables(spark, tmp_path):
    assert VersionedTable(spark, str(tmp_path / "none")).read() is None
    path = str(tmp_path / "e")
    overwrite_table(spark.range(0), path)
    assert read_or_none(spark, path).count() == 0


# -- filters -----------------------------------------------------------------------

def test_filters_pass_every_key_and_few_others(spark):
    keys = spark.range(20000).select(F.when(F.col("id") == 7, None).otherwise(F.concat(F.lit("k"), "id")).alias("key"),
                                     (F.col("id") % 2).cast("string").alias("g"))
    keys = keys.withColumn("blocks", F.lit(bloom.blocks_for(10000)).cast("long"))
    filters = bloom.build(keys, "g", "key", "blocks")
    assert bloom.maybe_in(keys, filters, "g", "key", "blocks").count() == 20000
    other = keys.withColumn("g", F.when(F.col("g") == "0", "1").otherwise("0"))
    assert bloom.maybe_in(other, filters, "g", "key", "blocks").count() < 600


# -- incremental staging -----------------------------------------------------------

def land(spark, lake, events, batch):
    """A raw telemetry batch as the stream writes it."""
    df = spark.createDataFrame(events, TELEMETRY)
    out = df.withColumns({"_row_seq": F.monotonically_increasing_id(), "_src_mtime": F.lit(batch), "_src_file": F.lit(f"f{batch}"),
                          "_src_offset": F.lit(0).cast("long"), **time_partitions(F.to_timestamp_ntz("timestamp"), with_day_hour=True),
                          "_batch_id": F.lit(f"e{batch:012d}-x")})
    write_batch_partitions(out, lake.raw_telemetry, PARTITIONS)


def event(n, day, hour=3, value=1.0, machine="M1"):
    return (None if n is None else f"evt_{n:06d}", machine, "f1", f"2026-03-{day:02d}T{hour:02d}:00:00", value, 1.0, 2.0, "Running ")


def stage(spark, lake):
    spec = INC.SPECS["telemetry"]
    return INC.stage_new_files(spark, lake.raw_telemetry, lake.staging("telemetry"), lake.staging_checkpoint("telemetry"), spec)


def assert_as_whole(spark, lake):
    want = ST.stage_telemetry(read_raw_parquet(spark, lake.raw_telemetry))
    got = read_or_none(spark, lake.staging("telemetry"))
    assert got.columns == want.columns and rows(got) == rows(want)


def test_only_days_that_a_batch_can_touch_are_read_and_rewritten(spark, lake):
    land(spark, lake, [event(100 * day + i, day) for day in range(1, 11) for i in range(20)], 0)
    assert stage(spark, lake) == 200
    table = VersionedTable(spark, lake.staging("telemetry"))
    before = table.current()
    assert len(before.parts) == 10
    # a new day, and a correction of an event of day 3 that arrives as one of day 4
    land(spark, lake, [event(5000 + i, 12) for i in range(5)] + [event(305, 4, value=9.0)], 1)
    assert stage(spark, lake) == 205
    after = table.current()
    changed = {p for p in after.parts if before.parts.get(p) != after.parts[p]}
    assert changed == {"2026-3-3", "2026-3-4", "2026-3-12"} == set(after.meta["touched"])
    assert_as_whole(spark, lake)
    # the merge plan reads the folders of the touched days alone
    spec = INC.SPECS["telemetry"]
    new = INC._parted(spark.read.schema(spec.raw_schema).parquet(lake.raw_telemetry).where("_batch_id like 'e000000000001%'"), spec, 1)
    assert sorted(INC.possible_parts(new, table, before, "event_id")) == ["2026-3-3"]
    plan = INC.merged_rows(table, spec, new, before, ["2026-3-3", "2026-3-4"])
    days = {f.split("staged_part=")[1].split("/")[0] for f in plan.inputFiles() if "staged_part=" in f}
    assert days == {"2026-3-3", "2026-3-4"}


def test_a_run_without_new_files_commits_nothing(spark, lake):
    land(spark, lake, [event(1, 1)], 0)
    assert stage(spark, lake) == 1
    number = VersionedTable(spark, lake.staging("telemetry")).current().number
    assert stage(spark, lake) == 1
    assert VersionedTable(spark, lake.staging("telemetry")).current().number == number


def test_random_batches_equal_staging_the_whole_history(spark, lake):
    rng = random.Random(9)
    for batch in range(4):
        land(spark, lake, [event(rng.choice([None, *range(40)]), rng.randrange(1, 9), rng.randrange(24), rng.random(), rng.choice(["M1", " m2 "]))
                           for _ in range(30)], batch)
        stage(spark, lake)
        assert_as_whole(spark, lake)
    table = VersionedTable(spark, lake.staging("telemetry"))
    staged = table.read()
    health = INC.side_table(table, "health")
    merged = INC.P.merge_health(health)
    got, want = ({r["machine_id"]: r for r in df.collect()} for df in (merged, M.machine_health_features(staged)))
    assert merged.columns == M.machine_health_features(staged).columns and set(got) == set(want)
    for m, r in want.items():
        assert [round(v, 9) if isinstance(v, float) else v for v in got[m]] == [round(v, 9) if isinstance(v, float) else v for v in r]
    assert rows(INC.P.merge_latest(INC.side_table(table, "latest"))) == rows(M.latest_event_per_machine(staged))
    profile = INC.table_profile(table).first()
    assert profile["rows"] == staged.count() and profile["null_event_id"] == staged.where("event_id is null").count()


def test_a_batch_committed_before_the_stream_noted_it_is_skipped(spark, lake):
    land(spark, lake, [event(1, 1)], 0)
    stage(spark, lake)
    table, spec = VersionedTable(spark, lake.staging("telemetry")), INC.SPECS["telemetry"]
    raw = spark.read.schema(spec.raw_schema).parquet(lake.raw_telemetry)
    assert INC.upsert(table, spec, raw, 0) is None and table.current().number == 1


def test_rebuild_equals_staging_and_goes_on(spark, lake):
    land(spark, lake, [event(i, 1 + i % 5) for i in range(20)], 0)
    stage(spark, lake)
    INC.rebuild(spark, lake.raw_telemetry, lake.staging("telemetry"), INC.SPECS["telemetry"])
    assert_as_whole(spark, lake)
    land(spark, lake, [event(3, 5, value=4.0), event(50, 6)], 1)
    stage(spark, lake)
    assert_as_whole(spark, lake)


def production(spark, lake, lines, batch):
    df = spark.createDataFrame(lines, "date string, machine_id string, shift string, units_produced long, scrap_units long, operator_id string")
    out = df.withColumns({**time_partitions(F.to_date("date")), "_batch_id": F.lit(batch)})
    write_batch_partitions(out, lake.raw_production, ["year", "month", "_batch_id"])


def test_a_production_batch_written_again_replaces_its_rows(spark, lake):
    production(spark, lake, [("2026-03-01", "m1", "A", 10, 1, "o"), ("2026-04-01", "m2", "A", 5, -3, "o")], "after-2026-02-28T00:00")
    assert J.run_staging(spark, lake)["production"] == 2
    production(spark, lake, [("2026-03-01", "m1", "A", 10, 1, "o"), ("2026-03-02", "m1", "A", 7, 0, "o")], "after-2026-02-28T00:00")
    production(spark, lake, [("2026-03-09", "m1", "B", 1, 1, "o")], "b2")
    assert J.run_staging(spark, lake)["production"] == 4
    got = read_or_none(spark, lake.staging("production"))
    assert rows(got) == rows(ST.stage_production(read_raw_parquet(spark, lake.raw_production)))
    table = VersionedTable(spark, lake.staging("production"))
    assert rows(INC.P.merge_scrap(INC.side_table(table, "scrap"))) == rows(M.scrap_rate_metrics(got))


def test_merged_maintenance_metrics(spark):
    logs = spark.createDataFrame([("p1", "m1", "repair", 10), ("p1", "m1", "repair", 0), ("p2", "m1", "check", 7), ("p2", "m9", "check", 3),
                                  ("p3", "m2", None, None)], "part string, machine_id string, maintenance_type string, downtime_minutes long")
    machines = spark.createDataFrame([("m1", "f1"), ("m2", "f2")], "machine_id string, factory_id string")
    from forgeline.operators import facts as FT
    want = M.factory_downtime_metrics(FT.fact_downtime(logs, machines))
    assert rows(INC.P.merge_downtime(INC.P.downtime_partials(logs, "part"), machines)) == rows(want)
    got = INC.P.merge_effectiveness(INC.P.effectiveness_partials(logs, "part"))
    assert rows(got) == rows(M.maintenance_effectiveness_metrics(logs))


def test_quality_counts_come_from_the_parts_not_from_rows(spark, lake):
    production(spark, lake, [("2026-03-01", "m1", "A", 10, 1, "o"), ("2026-03-02", None, "A", 5, 3, "o")], "b1")
    land(spark, lake, [event(1, 1), event(2, 1), event(None, 2)], 0)
    J.run_staging(spark, lake)
    profiles = J.staged_profiles(spark, lake)
    assert set(profiles) == {"telemetry", "production"}
    tables = {n: read_or_none(spark, lake.staging(n)) for n in profiles}
    checks = [Q.check_null_critical_fields(tables, profiles=profiles), Q.check_negative_production(tables["production"], profiles["production"])]
    wants = [Q.check_null_critical_fields(tables), Q.check_negative_production(tables["production"])]
    for got, want in zip(checks, wants):
        assert "FileScan" not in physical_plan(got) and "FileScan" in physical_plan(want)
        assert rows(got) == rows(want)
    report = {r["check_name"]: r for r in J.run_quality(spark, lake, fail_early=False)}
    assert report["null_critical_fields"]["details"] == "Nulls found: telemetry:event_id=1, production:machine_id=1"
