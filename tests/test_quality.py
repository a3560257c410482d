from conftest import rows
from forgeline.operators import quality as Q


def tel(spark, ids):
    return spark.createDataFrame([(i, "m1") for i in ids], "event_id string, machine_id string")


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0]


def test_gaps_too_few(spark):
    r = one(Q.check_missing_telemetry(tel(spark, ["evt_000001"])))
    assert (r.passed, r.severity, r.records_checked, r.records_failed) == (True, "info", 1, 0)


def test_gaps_none(spark):
    r = one(Q.check_missing_telemetry(tel(spark, ["evt_000001", "evt_000002", "evt_000003"])))
    assert (r.passed, r.details, r.records_checked) == (True, "No gaps in telemetry event sequence", 3)


def test_gaps_found_and_empty_skipped(spark):
    r = one(Q.check_missing_telemetry(tel(spark, ["evt_000001", "evt_000002", "evt_000005", "evt_000005",
                                                  "", None])))
    assert (r.passed, r.severity, r.records_checked, r.records_failed) == (False, "warning", 5, 2)
    assert r.details == "2 missing event(s) in sequence. Sample: evt_000003..evt_000004"


def test_gap_sample_first_ten(spark):
    ids = ["evt_1", "evt_5", "evt_7", "evt_100"]
    r = one(Q.check_missing_telemetry(tel(spark, ids)))
    # missing: 2,3,4,6,8..99 -> first ten end at 13
    assert r.records_failed == 96 and r.details.endswith("Sample: evt_000002..evt_000013")
    ranges = rows(Q.missing_event_ranges(tel(spark, ids)))
    assert ranges == [(2, 4, 3), (6, 6, 1), (8, 99, 92)]


def test_negative_cells_count_twice(spark):
    df = spark.createDataFrame([(-1, -2), (3, 0)], "units_produced long, scrap_units long")
    r = one(Q.check_negative_production(df))
    assert (r.passed, r.severity, r.records_failed, r.records_checked) == (False, "error", 2, 2)
    assert r.details == "1 negative units_produced, 1 negative scrap_units"


def test_null_fields(spark):
    t = spark.createDataFrame([(None, None, None), ("e", "m", None)],
                              "event_id string, machine_id string, timestamp timestamp_ntz")
    p = spark.createDataFrame([], "date date, machine_id string")
    r = one(Q.check_null_critical_fields({"telemetry": t, "production": p}))
    assert (r.passed, r.records_checked, r.records_failed) == (False, 6, 4)
    assert r.details == "Nulls found: telemetry:event_id=1, telemetry:machine_id=1, telemetry:timestamp=2"
    r = one(Q.check_null_critical_fields({"production": p}))
    assert (r.passed, r.records_checked, r.records_failed) == (True, 0, 0)


def test_mismatch_and_report(spark):
    machines = spark.createDataFrame([("m1",), ("m2",)], "machine_id string")
    t = spark.createDataFrame([("m1",), ("x9",), ("x1",), (None,)], "machine_id string")
    p = spark.createDataFrame([("m2",)], "machine_id string")
    r = one(Q.check_machine_id_mismatches(machines, {"telemetry": t, "production": p}))
    assert (r.passed, r.severity, r.records_checked, r.records_failed) == (False, "warning", 2, 3)
    assert r.details == "Unknown machine_ids — telemetry: 3"


def test_report_order_and_summary(spark):
    machines = spark.createDataFrame([("m1",)], "machine_id string")
    telemetry = spark.createDataFrame([("evt_1", "m1", None)],
                                      "event_id string, machine_id string, timestamp timestamp_ntz")
    report = Q.quality_report(telemetry, None, None, machines)
    got = [(r.check_name, r.passed, r.severity) for r in report.orderBy("check_order").collect()]
    assert got == [("missing_telemetry", True, "info"), ("negative_production", False, "error"),
                   ("machine_id_mismatch", True, "info"), ("null_critical_fields", False, "error")]
    s = Q.quality_summary(report).first()
    assert (s.total, s.passed, s.failed) == (4, 2, 2)
    assert Q.first_blocking_failure(report).first().check_name == "negative_production"


def test_gap_sample_more_than_ten_gaps(spark):
    ids = [f"evt_{i}" for i in range(0, 41, 2)]  # 1, 3, ..., 39 missing
    r = one(Q.check_missing_telemetry(tel(spark, ids)))
    assert r.records_failed == 20 and r.details.endswith("Sample: evt_000001..evt_000019")
    got = [x.n for x in Q.missing_event_sample(tel(spark, ids)).collect()]
    assert got == list(range(1, 20, 2))


def test_unknown_ids_are_all_listed(spark):
    machines = spark.createDataFrame([("m1",)], "machine_id string")
    t = spark.createDataFrame([(f"u{i:02d}",) for i in range(25)], "machine_id string")
    assert one(Q.check_machine_id_mismatches(machines, {"telemetry": t})).details.endswith("telemetry: 25")
    assert Q.unknown_machine_ids(machines, {"telemetry": t}).count() == 25


def test_every_gap_of_made_up_numbers(spark):
    import random
    rng = random.Random(4)
    for ids in ([0, 32767, 32768, 32769, 70000, 3 * 10**9, 3 * 10**9 + 5], [5], list(range(40000)),
                [i for i in range(150000) if rng.random() < 0.9 and not 60000 < i < 140000]):
        df = tel(spark, [f"evt_{i:06d}" for i in ids])
        want = [(a + 1, b - 1, b - a - 1) for a, b in zip(sorted(ids), sorted(ids)[1:]) if b > a + 1]
        assert rows(Q.missing_event_ranges(df)) == sorted(want, key=lambda t: tuple((True, str(v)) for v in t))
        first = [n for a, b, _ in want for n in range(a, min(b, a + 10) + 1)][:10]
        assert sorted(r["n"] for r in Q.missing_event_sample(df).collect()) == first
