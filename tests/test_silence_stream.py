import json

from conftest import rows, ts
from forgeline.operators import alerts as A
from forgeline.streaming.silence import CHANGE, current_status, follow_silence, silent_machines


def _write(path, events):
    path.write_text("".join(json.dumps({"event_id": f"evt_{path.stem}_{i}", "machine_id": m, "timestamp": t}) + "\n"
                            for i, (m, t) in enumerate(events)))


def _changes(spark, lake):
    return spark.read.schema(CHANGE).parquet(lake.silence_changes)


def _items_of_all(spark, sent, machines, as_of):
    tel = spark.createDataFrame([(m, ts(t)) for m, t in sent], "machine_id string, timestamp timestamp_ntz")
    return rows(A.telemetry_silence_items(tel, machines, as_of))


def test_silent_and_back_equals_the_batch_items(spark, lake, tmp_path):
    landing, clock = tmp_path / "landing", tmp_path / "clock"
    landing.mkdir()
    clock.mkdir()
    machines = spark.createDataFrame([("a",), ("b",), ("c",), ("none",)], "machine_id string")
    sent, as_of = [], None

    def step(n, events, now):
        nonlocal as_of
        _write(landing / f"e{n}.jsonl", events)
        _write(clock / f"t{n}.jsonl", [(None, now)])
        sent.extend((m.strip().lower(), t) for m, t in events)
        as_of = ts(now)
        follow_silence(spark, lake, str(landing), str(clock)).awaitTermination()
        got = rows(silent_machines(_changes(spark, lake), machines, as_of))
        assert got == _items_of_all(spark, sent, machines, as_of), n
        return [r[0] for r in got]

    assert step(0, [(" A ", "2026-03-02T10:00:00"), ("b", "2026-03-02T09:30:00"), ("c", "2026-03-02T10:59:00"), ("a", "2026-03-02T09:00:00")],
                "2026-03-02T11:00:00") == ["b", "none"]  # a: exactly an hour, not yet
    assert step(1, [("b", "2026-03-02T11:30:00")], "2026-03-02T11:45:00") == ["a", "none"]  # b is back
    assert step(2, [("a", "2026-03-02T10:30:00")], "2026-03-02T12:45:00") == ["a", "b", "c", "none"]  # a's late event: still silent, a later last one
    assert step(3, [(m, "2026-03-02T12:50:00") for m in "abc"], "2026-03-02T13:00:00") == ["none"]
    assert {r.status for r in current_status(_changes(spark, lake)).collect()} == {"active"}


def test_restart_reads_no_file_twice_and_times_may_be_missing(spark, lake, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    _write(landing / "e0.jsonl", [("a", "2026-03-02T10:00:00"), ("b", None), ("z", "2026-03-02T12:00:00")])
    follow_silence(spark, lake, str(landing)).awaitTermination()
    before = rows(_changes(spark, lake))
    assert ("a", "silent", ts("2026-03-02T10:00:00"), 2) in before and not [r for r in before if r[0] == "b"]
    follow_silence(spark, lake, str(landing)).awaitTermination()
    assert rows(_changes(spark, lake)) == before
