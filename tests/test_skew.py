"""A key holding a third of all rows: results stay whole and exact, and the
plans combine the hot key before the shuffle."""

from pyspark.sql import functions as F

from forgeline.operators import metrics as M
from forgeline.operators import staging as ST
from forgeline.plans.inspect import physical_plan
from forgeline.schemas import RAW_TELEMETRY
from forgeline.sources.files import read_json_document


def _telemetry(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("evt_hot")).otherwise(F.concat(F.lit("evt_"), F.col("id").cast("string")))
        .alias("event_id"),
        F.when(F.col("id") % 3 == 1, F.lit("m_hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 97).cast("string")))
        .alias("machine_id"),
        (F.col("id") % 50).cast("double").alias("temperature_c"),
        F.lit(1.0).alias("vibration_mm_s"), F.lit(2.0).alias("power_kw"),
        F.lit("b1").alias("_batch_id"), F.col("id").alias("_row_seq"))
    return df.repartition(8)


def test_hot_event_id_dedup_keeps_last_only(spark):
    df = _telemetry(spark)
    out = ST.keep_last(df, "event_id")
    assert out.count() == 1 + 20000
    assert out.where("event_id = 'evt_hot'").first()._row_seq == 29997
    plan = physical_plan(out)
    # printed top-down: the last WindowGroupLimit sits below the exchange (the partial one)
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_hot_machine_health_is_whole(spark):
    df = _telemetry(spark)
    health = {r.machine_id: r for r in M.machine_health_features(df).collect()}
    assert health["m_hot"].event_count == 10000
    expected = sum(float(i % 50) for i in range(1, 30000, 3)) / 10000
    assert health["m_hot"].avg_temperature_c == expected
    assert "partial_" in physical_plan(M.machine_health_features(df))


def test_json_document(spark, tmp_path):
    (tmp_path / "doc.json").write_text('{\n  "event_id": "evt_1",\n  "temperature_c": 71.5\n}\n')
    r = read_json_document(spark, str(tmp_path / "doc.json"), RAW_TELEMETRY).first()
    assert (r.event_id, r.temperature_c) == ("evt_1", 71.5)
    assert read_json_document(spark, str(tmp_path / "none.json"), RAW_TELEMETRY) is None
