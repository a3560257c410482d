"""Hours of many small batches become a few files; staging stays as it was."""

from conftest import rows
from pyspark.sql import functions as F

from forgeline import compaction as K
from forgeline import incremental as INC
from forgeline import jobs as J
from forgeline.functions.time import time_partitions
from forgeline.operators import staging as ST
from forgeline.sinks.files import write_batch_partitions
from forgeline.sinks.versions import VersionedTable
from forgeline.sources.files import read_or_none
from forgeline.streaming.telemetry import PARTITIONS, batch_label

COLUMNS = "event_id string, machine_id string, factory_id string, timestamp string, temperature_c double, vibration_mm_s double, power_kw double, status string"


def _land(spark, lake, epoch, events):
    """A batch of (number, hour, temperature); an hour of None has no time."""
    data = [(f"evt_{n:04d}", "M1", "f", None if h is None else f"2026-03-02T{h:02d}:00:{n % 60:02d}", t, 1.0, 2.0, "ok") for n, h, t in events]
    df = spark.createDataFrame(data, COLUMNS)
    write_batch_partitions(df.withColumns({
        "_row_seq": F.monotonically_increasing_id(), "_src_mtime": F.lit(epoch).cast("long"), "_src_file": F.lit(f"f{epoch}"), "_src_offset": F.lit(0).cast("long"),
        **time_partitions(F.to_timestamp_ntz("timestamp"), with_day_hour=True), "_batch_id": F.lit(batch_label(epoch, "s"))}), lake.raw_telemetry, PARTITIONS)


def _raw(spark, lake):
    spec = INC.SPECS["telemetry"]
    raw = spark.read.schema(spec.raw_schema).option("pathGlobFilter", "*.parquet").parquet(lake.raw_telemetry)
    moved = K.compacted_rows(spark, lake, "telemetry")
    return raw if moved is None else raw.unionByName(moved)


def _staged(spark, lake):
    return rows(read_or_none(spark, lake.staging("telemetry")))


def test_crowded_hours_are_moved_and_staging_stays(spark, lake):
    for e in range(5):  # event 1 comes again in every batch, event 7 has no time
        _land(spark, lake, e, [(1, 10, float(e)), (10 + e, 10, 1.0), (7, None, float(e))])
    _land(spark, lake, 5, [(50, 11, 3.0)])
    before = rows(_raw(spark, lake))
    assert K.compact_telemetry(spark, lake, over=3) == K.Moved(2, 10)
    assert rows(_raw(spark, lake)) == before
    table = VersionedTable(spark, lake.compacted("telemetry"))
    assert len(table.read(every_column=True).inputFiles()) == 2 and K.crowded_files(spark, lake.raw_telemetry, 3) == []
    want = rows(ST.stage_telemetry(_raw(spark, lake)).select(*ST.TELEMETRY_COLUMNS))
    assert _staged(spark, lake) == want and (len(want), [r[4] for r in want if r[0] == "evt_0001"]) == (8, [4.0])

    # more batches for the same hour: one that is late for event 1, then compacted with the first ones
    for e in range(6, 10):
        _land(spark, lake, e, [(1, 10, 100.0 + e), (100 + e, 10, 1.0)])
    J.run_staging(spark, lake)
    assert [r[4] for r in _staged(spark, lake) if r[0] == "evt_0001"] == [109.0]
    assert K.compact_telemetry(spark, lake, over=3) == K.Moved(1, 4)
    assert len(table.read(every_column=True).inputFiles()) == 2
    J.run_staging(spark, lake)
    incremental = _staged(spark, lake)
    J.run_staging(spark, lake, full=True)  # from the compacted rows and the rest
    assert _staged(spark, lake) == incremental and len(incremental) == 12


def test_a_stop_before_the_delete_changes_no_answer(spark, lake):
    for e in range(4):
        _land(spark, lake, e, [(1, 10, float(e)), (20 + e, 10, 1.0)])
    J.run_staging(spark, lake)
    staged = _staged(spark, lake)
    files = K.crowded_files(spark, lake.raw_telemetry, 2)
    kept = {f: open(f.removeprefix("file:"), "rb").read() for f in files}
    K.move(spark, lake.raw_telemetry, VersionedTable(spark, lake.compacted("telemetry")), INC.SPECS["telemetry"], files)
    for f, data in kept.items():  # as if nothing had been deleted
        open(f.removeprefix("file:"), "wb").write(data)
    J.run_staging(spark, lake, full=True)
    assert _staged(spark, lake) == staged


def test_oldest_hours_first_and_nothing_to_do(spark, lake):
    assert K.compact_telemetry(spark, lake) == K.Moved(0, 0)
    for e in range(3):
        _land(spark, lake, e, [(e, 10, 1.0), (10 + e, 11, 1.0)])
    assert K.compact_telemetry(spark, lake, over=3) == K.Moved(0, 0)
    some = K.crowded_files(spark, lake.raw_telemetry, 2, most_files=4)
    assert len(some) == 3 and all("hour=10" in f for f in some)
