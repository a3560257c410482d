"""Foreign keys against a parent that is too large to broadcast."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from forgeline.operators import bloom
from forgeline.operators import extensions as X
from forgeline.plans.inspect import physical_plan


@pytest.fixture()
def no_broadcast(spark):
    names = {"forgeline.maxBroadcastBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _children(spark, n=30000):
    """A third of the rows have one key that has a parent, a tenth one that has none; some have none at all."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(-5)).when(F.col("id") % 97 == 2, F.lit(None)) \
        .otherwise(F.col("id") % 6000).cast("long")
    return spark.range(n).select(F.col("id").alias("row"), key.alias("machine_id"), F.lit("x").alias("__block"))


def test_large_parent_gives_the_same_rows(spark, no_broadcast):
    child, parent = _children(spark), spark.range(5000).select(F.col("id").alias("machine_id"))
    got = X.fk_violations(child, parent, "machine_id")
    want = [(r.row,) for r in child.collect() if r.machine_id is not None and not 0 <= r.machine_id < 5000]
    assert got.columns == child.columns and len(want) > 3000
    assert rows(got, "row") == sorted(want, key=lambda t: str(t[0]))


def test_only_possible_strangers_are_shuffled(spark, no_broadcast):
    child, parent = _children(spark), spark.range(5000).select(F.col("id").alias("machine_id"))
    plan = physical_plan(X.fk_violations(child, parent, "machine_id"))
    lines = plan.splitlines()
    # the rows (they have the column row) meet the filter below the exchange to the exact join
    probe = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "getbit" in line)
    below = lines[probe:next(i for i, line in enumerate(lines) if i > probe and "BroadcastExchange" in line)]
    assert any("AS row#" in line for line in below) and not any("Exchange" in line for line in below)
    assert any("Exchange hashpartitioning(machine_id" in line for line in lines[:probe])


def test_overfull_filter_loses_no_row(spark):
    child = spark.range(2000).select(F.col("id").alias("k"))
    keys = spark.range(0, 2000, 2).select(F.col("id").alias("k"))
    assert bloom.rows_of(child, keys, "k", blocks=1).count() == 1000
    assert bloom.rows_of(child, keys.limit(0), "k").count() == 0
    assert bloom.rows_of(child.limit(0), keys, "k").count() == 0


def test_a_parent_that_grew_is_measured_anew(spark, tmp_path):
    """The answer of a size probe does not outlive the files it was made for."""
    from forgeline.plans.joins import fits_broadcast

    path = str(tmp_path / "parent")
    ids = spark.range(10).select(F.col("id").alias("k"))
    ids.write.parquet(path)

    def fits():
        parent = spark.read.schema("k long").parquet(path)
        return fits_broadcast(parent.join(ids, "k", "left").select("k"), 8 * 1000)

    assert fits()
    spark.range(10, 5000).select(F.col("id").alias("k")).write.mode("append").parquet(path)
    assert not fits()
