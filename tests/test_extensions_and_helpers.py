
from pyspark.sql import functions as F

from conftest import rows, ts
from forgeline.functions.text import zero_pad
from forgeline.operators import extensions as X
from forgeline.plans.materialize import materialize, one_row
from forgeline.schemas import RAW_TELEMETRY
from forgeline.sources.files import read_csv_by_name, read_jsonl, read_or_none, read_raw_parquet


def test_zero_pad_matches_printf(spark):
    df = spark.createDataFrame([(v,) for v in (0, 7, 12345, 1234567, -42)], "x long")
    got = [r[0] for r in df.select(zero_pad(F.col("x"), 5)).collect()]
    assert got == ["00000", "00007", "12345", "1234567", "-0042"]


def test_one_row_and_materialize(spark):
    a = spark.range(10).agg(F.count(F.lit(1)).alias("n"))
    b = spark.range(5).agg(F.max("id").alias("m"), F.lit("x").alias("t"))
    assert one_row(a, b).collect()[0].asDict() == {"n": 10, "m": 4, "t": "x"}
    m = materialize(spark.range(100).withColumn("y", F.col("id") * 2), "test")
    assert m.agg(F.sum("y")).first()[0] == 9900


def test_absent_paths_read_as_none(spark, tmp_path):
    assert read_or_none(spark, str(tmp_path / "nothing")) is None
    assert read_raw_parquet(spark, str(tmp_path / "nothing")) is None
    assert read_jsonl(spark, str(tmp_path / "nothing"), RAW_TELEMETRY) is None


def test_jsonl_blank_lines_and_unknown_keys(spark, tmp_path):
    f = tmp_path / "e.jsonl"
    f.write_text('{"event_id": "evt_1", "junk": 3, "temperature_c": 70.5}\n\n{"event_id": "evt_2"}\n')
    df = read_jsonl(spark, str(f), RAW_TELEMETRY)
    assert rows(df, "event_id", "temperature_c") == [("evt_1", 70.5), ("evt_2", None)]
    assert "junk" not in df.columns and "_src_file" in df.columns


def test_csv_missing_column_is_null(spark, tmp_path):
    from forgeline.schemas import RAW_PRODUCTION

    f = tmp_path / "p.csv"
    f.write_text("date,machine_id,units_produced\n2026-03-01,m1,5\n")
    r = read_csv_by_name(spark, str(f), RAW_PRODUCTION).first()
    assert (r.units_produced, r.scrap_units, r.shift) == (5, None, None)


def test_row_counts_and_keys(spark):
    t = {"a": spark.range(5).toDF("x"), "b": spark.range(1).toDF("x")}
    assert rows(X.row_count_threshold(t, {"a": 3, "b": 3})) == [("a", 5, 3, True), ("b", 1, 3, False)]
    df = spark.createDataFrame([("k1",), ("k1",), ("k2",)], "k string")
    assert rows(X.pk_violations(df, "k")) == [("k1", 2)]
    child = spark.createDataFrame([("c1", "m1"), ("c2", "zz"), ("c3", None)], "id string, machine_id string")
    parent = spark.createDataFrame([("m1",)], "machine_id string")
    assert rows(X.fk_violations(child, parent, "machine_id"), "id") == [("c2",)]


def test_missing_event_windows(spark):
    tel = spark.createDataFrame([
        ("m1", ts("2026-01-01T00:10:00")), ("m1", ts("2026-01-01T03:05:00")), ("m2", ts("2026-01-01T05:00:00"))],
        "machine_id string, timestamp timestamp_ntz")
    assert rows(X.missing_event_windows(tel)) == [("m1", ts("2026-01-01T01:00:00")), ("m1", ts("2026-01-01T02:00:00"))]


def test_flags_enums_defaults(spark):
    ev = spark.createDataFrame([("e1", "m", None, 96.0, 1.0), ("e2", "m", None, 86.0, 4.0), ("e3", "m", None, None, None)],
                               "event_id string, machine_id string, timestamp timestamp_ntz, temperature_c double, "
                               "vibration_mm_s double")
    assert rows(X.health_flags(ev), "event_id", "temperature_flag", "high_vibration") == [
        ("e1", "critical", False), ("e2", "warning", True), ("e3", "unknown", False)]
    m = spark.createDataFrame([("m1", "assembly", "active"), ("m2", "robot", None)],
                              "machine_id string, machine_type string, status string")
    assert rows(X.enum_validation(m)) == [("machine_type", "robot", 1), ("status", None, 1)]
    assert rows(X.apply_defaults(m, "machines"), "machine_id", "status") == [("m1", "active"), ("m2", "active")]
