"""Properties: idempotence and independence from the
partition layout. Few examples each, since every example runs Spark jobs."""

import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from forgeline.operators import metrics as M
from forgeline.operators import staging as ST
from forgeline.operators import warehouse as W

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keyed_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3), st.integers(0, 5)),
                      min_size=1, max_size=40)


@SETTINGS
@given(keyed_rows, st.integers(1, 6))
def test_keep_last_idempotent_and_layout_free(spark, data, parts):
    data = [(k, h, f"b{b}", i) for i, (k, h, b) in enumerate(data)]
    df = spark.createDataFrame(data, "k string, hour int, _batch_id string, _row_seq long")
    once = ST.keep_last(df, "k")
    assert rows(ST.keep_last(once, "k")) == rows(once)
    assert rows(ST.keep_last(df.repartition(parts), "k")) == rows(once)
    # the survivor of each key is the maximum of the scan order
    best = {}
    for k, h, b, i in data:
        if k not in best or (h, b, i) > best[k][1:]:
            best[k] = (k, h, b, i)
    assert rows(once) == rows(spark.createDataFrame(list(best.values()), df.schema))


@SETTINGS
@given(st.lists(st.text(alphabet=" \tAbC", max_size=6), min_size=1, max_size=20))
def test_normalize_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    once = ST.normalize_strings(df, ["s"])
    assert rows(ST.normalize_strings(once, ["s"])) == rows(once)
    assert sorted(r.s for r in once.collect()) == sorted(t.lower().strip(" ") for t in texts)


def test_means_are_not_cut(spark):
    for values, mean in (((1e-9, 3e-9), 2e-9), ((1 / 3, 1 / 3), 1 / 3), ((1e12, 3e12), 2e12)):
        df = spark.createDataFrame([("m", v, "e", 1.0, 1.0) for v in values],
                                   "machine_id string, temperature_c double, event_id string, "
                                   "vibration_mm_s double, power_kw double")
        assert M.machine_health_features(df).first().avg_temperature_c == mean


@SETTINGS
@given(st.lists(st.integers(0, 500), min_size=2, max_size=60))
def test_variability_matches_exact_statistics(spark, units):
    df = spark.createDataFrame([("m", u) for u in units], "machine_id string, units_produced long")
    out = W.lines_abnormal_variability(df).collect()
    mean = sum(units) / len(units)
    if mean == 0:
        assert out == []
        return
    std = statistics.pstdev(units)
    r = out[0]
    assert r.data_points == len(units)
    assert abs(r.std_units - round(std, 1)) <= 0.1 + 1e-9
    assert r.abnormal == (std / mean > 0.15) or abs(std / mean - 0.15) < 1e-12
