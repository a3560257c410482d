"""Every registered query against its DuckDB oracle on the driver's
sf0.001 tables (the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.library_queries()) == set(E._library_oracle_sql())


@pytest.mark.parametrize("key", sorted(E.library_queries()))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.library_queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E._library_oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert sorted(canon(sdf.columns, srows)) == sorted(canon(dcols, drows))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["factory_id", "total_downtime_minutes", "avg_downtime_minutes",
                                             "downtime_events"]


@pytest.mark.parametrize("key", ["stage_telemetry", "stage_maintenance", "telemetry_status",
                                 "overheating_before_shutdown", "missing_event_windows", "alert_late_data"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_query_matches_oracle(spark, duck, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
