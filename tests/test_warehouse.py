from conftest import rows, ts
from forgeline.operators import warehouse as W

HEALTH = ("machine_id string, avg_temperature_c double, max_temperature_c double, "
          "avg_vibration_mm_s double, max_vibration_mm_s double, avg_power_kw double, event_count long")


def test_trending_reasons_and_zero(spark):
    health = spark.createDataFrame([
        ("exact75", 75.0, 80.0, 1.0, 1.0, 1.0, 1),     # not > 75
        ("hot", 80.25, 91.0, None, None, 1.0, 1),       # two reasons, null vibration skipped
        ("zero", 0.0, 0.0, 3.5, 4.0, 1.0, 1),           # 0 shown as null
    ], HEALTH)
    out = {r.machine_id: r for r in W.machines_trending_toward_failure(health).collect()}
    assert set(out) == {"hot", "zero"}
    assert out["hot"].risk_factors == ["avg_temp=80.3°C", "max_temp=91.0°C"]
    assert out["zero"].avg_temperature_c is None and out["zero"].risk_factors == ["avg_vibration=3.50mm/s"]
    ordered = [r.machine_id for r in W.machines_trending_toward_failure(health).collect()]
    assert ordered == ["hot", "zero"]


def _tel(spark, data):
    return spark.createDataFrame(
        [(f"e{i}", m, t and ts(t), temp, s) for i, (m, t, temp, s) in enumerate(data)],
        "event_id string, machine_id string, timestamp timestamp_ntz, temperature_c double, status string")


def test_overheating_cases(spark):
    tel = _tel(spark, [
        ("last", "2026-01-01T00:00:00", 70.0, "running"),
        ("last", "2026-01-01T01:00:00", 99.0, "running"),      # hot row last -> none
        ("run", "2026-01-01T00:00:00", 99.0, "running"),
        ("run", "2026-01-01T01:00:00", 70.0, "running"),       # hot then running -> none
        ("two", "2026-01-01T00:00:00", 86.04, "running"),
        ("two", "2026-01-01T01:00:00", 70.0, "idle"),          # first pair
        ("two", "2026-01-01T02:00:00", 95.0, "running"),
        ("two", "2026-01-01T03:00:00", 70.0, "off"),
    ])
    out = W.overheating_before_shutdown(tel).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.machine_id, r.hot_event_temp, r.next_status) == ("two", 86.0, "idle")
    assert r.hot_event_time == ts("2026-01-01T00:00:00") and r.next_time == ts("2026-01-01T01:00:00")


def test_overheating_hot_machine_spread_over_partitions(spark):
    # one machine holds most rows; the answer must not depend on partitioning
    data = [("big", f"2026-01-01T{h:02d}:{m:02d}:00", 90.0 if (h, m) == (7, 30) else 60.0,
             "error" if (h, m) == (7, 31) else "running") for h in range(24) for m in range(60)]
    data += [("small", "2026-01-01T00:00:00", 99.0, "running"), ("small", "2026-01-01T00:00:01", 50.0, "off")]
    out = rows(W.overheating_before_shutdown(_tel(spark, data).repartition(7)), "machine_id", "next_status")
    assert out == [("big", "error"), ("small", "off")]


def test_next_readings_of_a_hot_machine_equal_a_plain_walk(spark):
    import random
    rng = random.Random(2)
    data = []
    for i in range(900):
        machine = "hot" if i % 3 else rng.choice(["a", "b", None])
        at = None if i % 50 == 0 else f"2026-01-{rng.randrange(1, 9):02d}T{rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
        data.append((machine, at, rng.choice([60.0, 90.0, 99.0]), rng.choice(["running", "idle", "off"])))
    tel = _tel(spark, data).repartition(6)
    by_machine = {}
    for r in tel.collect():
        by_machine.setdefault(r["machine_id"], []).append(r)
    want = []
    for own in by_machine.values():
        own.sort(key=lambda r: (r["timestamp"] is not None, str(r["timestamp"]), r["event_id"]))
        want += [(a["machine_id"], a["timestamp"], a["event_id"], a["temperature_c"], b["status"], b["timestamp"]) for a, b in zip(own, own[1:])]
    assert sorted(map(repr, map(tuple, W.next_readings(tel).collect()))) == sorted(map(repr, want))


def test_top10_ties_by_id(spark):
    data = [(f"m{i:02d}", 1) for i in range(12) for _ in range(1 if i % 2 else 2)]
    df = spark.createDataFrame(data, "machine_id string, downtime_minutes long")
    out = [r.machine_id for r in W.frequently_failing_machines(df).collect()]
    assert out == ["m00", "m02", "m04", "m06", "m08", "m10", "m01", "m03", "m05", "m07"]


def test_variability_cases(spark):
    df = spark.createDataFrame(
        [("one", 5), ("zero", 0), ("zero", 0), ("const", 4), ("const", 4), ("mix", 1), ("mix", 3)],
        "machine_id string, units_produced long")
    out = {r.machine_id: r for r in W.lines_abnormal_variability(df).collect()}
    assert set(out) == {"const", "mix"}
    assert (out["const"].cv, out["const"].abnormal) == (0.0, False)
    assert (out["mix"].std_units, out["mix"].cv, out["mix"].abnormal, out["mix"].data_points) == (1.0, 0.5, True, 2)


def test_sorted_answers(spark):
    eff = spark.createDataFrame([("a", 5.55, 10, 2), ("b", 1.0, 3, 3)],
                                "maintenance_type string, avg_downtime_minutes double, "
                                "total_downtime_minutes long, event_count long")
    assert [r.maintenance_type for r in W.maintenance_reducing_downtime(eff).collect()] == ["b", "a"]
    scrap = spark.createDataFrame([("m1", 10, 1, 0.123456), ("m2", 10, 5, 0.5)],
                                  "machine_id string, total_units_produced long, total_scrap_units long, "
                                  "scrap_rate double")
    out = W.machines_high_scrap(scrap).collect()
    assert [r.machine_id for r in out] == ["m2", "m1"] and out[1].scrap_rate == 0.1235
