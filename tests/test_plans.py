"""Plan-shape checks: the decisions that matter at scale are visible in the
physical plan, so they are asserted here."""

import pytest

import __spark_entry__ as E
from forgeline.operators import incremental as INC
from forgeline.plans.inspect import count_nodes, physical_plan, python_nodes
from forgeline.plans.joins import lookup_join
from forgeline.sources import testbind as TB

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(E.library_queries()))
def test_no_python_in_any_query(spark, key):
    assert python_nodes(E.queries()[key](spark, SF)) == []


def test_python_in_a_plan_is_seen(spark):
    def same(batches):
        yield from batches

    df = spark.range(3)
    for found in (df.mapInArrow(same, "id long"), df.mapInPandas(same, "id long"), df.groupBy("id").applyInArrow(lambda t: t, "id long")):
        assert python_nodes(found)


def test_mark_filter_reaches_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    TB.raw_production(spark, SF).write.parquet(path)
    df = INC.after_mark(spark.read.parquet(path), "date", "2000-01-01")
    plan = physical_plan(df)
    assert "PushedFilters: [IsNotNull(date), GreaterThan(date,2000-01-01)]" in plan


def test_projection_is_pruned_at_scan(spark):
    plan = physical_plan(E.queries()["scrap_rate_metrics"](spark, SF))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_discount:double>" in plan


def test_aggregations_are_partial_before_shuffle(spark):
    for key in ["machine_health_features", "scrap_rate_metrics", "factory_downtime_metrics",
                "lines_abnormal_variability"]:
        plan = physical_plan(E.queries()[key](spark, SF))
        assert "partial_" in plan, key


def test_dimension_broadcast_only_under_size_limit(spark):
    prod = spark.range(1000).selectExpr("cast(id % 7 as string) as machine_id", "id as units")
    dim = spark.range(7).selectExpr("cast(id as string) as machine_id", "'f' as factory_id")

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()

    small = lookup_join(prod, dim, "machine_id")
    assert hinted(small) and "BroadcastHashJoin" in physical_plan(small)
    big = lookup_join(prod, dim, "machine_id", max_broadcast_bytes=1)
    assert not hinted(big)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in physical_plan(lookup_join(prod, dim, "machine_id", max_broadcast_bytes=1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dedup_limits_groups_before_shuffle(spark):
    plan = physical_plan(E.queries()["stage_telemetry"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_next_reading_looks_at_one_machine_and_hour(spark):
    """Lazy, over the staged rows; the window that sees rows is cut by hour, the one by machine sees one row an hour."""
    plan = physical_plan(E.queries()["overheating_before_shutdown"](spark, SF))
    assert "RangePartitioning" not in plan and "forgeline-tables" not in plan  # no global sort, no copy
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "lead(" in line]
    assert len(windows) == 2 and all("machine_id" in w and "hour" in w for w in windows)
