"""Raw factory tables derived from the driver's TPC-H-like test tables.

The driver's data has no factory tables, so each raw table is a fixed
projection of a whole driver table (no row is filtered out):

* machines     <- supplier x nation x region (one machine per supplier)
* telemetry    <- events: batch 0 is every event; batch 1 re-sends the
                  error events with dirty ids and corrected readings
* production   <- lineitem (one production row per line item)
* maintenance  <- orders (one maintenance log per order)

The same expressions are written in DuckDB SQL in ``__spark_entry__`` so the
results can be checked against an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forgeline.plans.joins import lookup_join
from forgeline.plans.materialize import materialize


_PLANS: dict[tuple, DataFrame] = {}


def _cached(spark: SparkSession, key: tuple, build) -> DataFrame:
    """DataFrames of the binding are immutable plans over read-only files:
    one plan object per session and table serves every query (each query
    still runs over the whole table)."""
    try:
        session = spark._jsparkSession.sessionUUID()
    except Exception:  # pragma: no cover - Spark Connect
        session = getattr(spark, "session_id", id(spark))
    full = (session, *key)
    if full not in _PLANS:
        _PLANS[full] = build()
    return _PLANS[full]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. (Spreading the single-split test files over all cores
    with a round-robin shuffle was measured slower than scanning them in one
    task, so scans are left as they are.)"""
    return _cached(spark, ("table", sf_dir, name),
                   lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _pad(expr: str, width: int) -> str:
    """SQL text of ``zero_pad`` for a non-negative integer expression (the
    bound ids are keys and never negative)."""
    t = f"cast({expr} as string)"
    return f"CASE WHEN length({t}) >= {width} THEN {t} ELSE lpad({t}, {width}, '0') END"


def _iso(ts_ntz: str) -> str:
    """``yyyy-MM-dd'T'HH:mm:ss`` text of a zone-less timestamp, built from its
    own text (``date_format`` would go through the session time zone)."""
    return f"replace(substr(cast({ts_ntz} AS string), 1, 19), ' ', 'T')"


def raw_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS s_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey AS n_regionkey", "r_name")
    geo = lookup_join(nation, region, "n_regionkey", how="inner")
    joined = lookup_join(supplier, geo, "s_nationkey", how="inner")
    return joined.selectExpr(
        f"concat('mach_', {_pad('s_suppkey', 5)}) AS machine_id",
        f"concat('fac_', {_pad('s_nationkey', 2)}) AS factory_id",
        "lower(r_name) AS machine_type",
        "cast(date_add(DATE'2020-01-01', cast(s_suppkey AS int)) AS string) AS install_date",
        "CASE WHEN s_acctbal < 0 THEN 'maintenance' ELSE 'active' END AS status",
        "'0' AS _batch_id",
        "s_suppkey AS _row_seq",
    )


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry with its scan-order columns (hour partition, batch, row)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    common = [
        f"concat('evt_', {_pad('event_id', 6)}) AS event_id",
        None,  # machine_id
        f"concat('fac_', {_pad('user_id % 25', 2)}) AS factory_id",
        f"{_iso('ts')} AS timestamp",
        None,  # temperature_c
        "cast(get_json_object(props, '$.k') AS int) * 0.05859375D AS vibration_mm_s",
        "value * 0.5D AS power_kw",
        None,  # status
        None,  # _batch_id
        "year(ts) AS year", "month(ts) AS month", "dayofmonth(ts) AS day", "hour(ts) AS hour",
        "event_id AS _row_seq",
    ]

    def batch(machine, temperature, status, label):
        cols = list(common)
        cols[1], cols[4], cols[7], cols[8] = machine, temperature, status, f"'{label}' AS _batch_id"
        return cols

    first = ev.selectExpr(*batch(
        f"concat('mach_', {_pad('user_id', 5)}) AS machine_id",
        "68.0D + value * 0.125D AS temperature_c",
        "CASE event_type WHEN 'purchase' THEN 'Idle' WHEN 'signup' THEN 'OFF ' "
        "WHEN 'error' THEN 'error' ELSE 'running' END AS status", "0"))
    resent = ev.where("event_type = 'error'").selectExpr(*batch(
        f"concat(' MACH_', {_pad('user_id', 5)}, ' ') AS machine_id",
        "69.0D + value * 0.125D AS temperature_c",
        "'ERROR' AS status", "1"))
    return first.unionByName(resent)


def raw_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_suppkey", "l_returnflag", "l_quantity", "l_discount", "l_partkey")
    return li.selectExpr(
        "cast(cast(l_shipdate AS date) AS string) AS date",
        f"concat('mach_', {_pad('l_suppkey', 5)}) AS machine_id",
        "l_returnflag AS shift",
        "cast(l_quantity AS bigint) AS units_produced",
        "(cast(l_quantity AS bigint) * cast(round(l_discount * 100) AS bigint)) div 80 AS scrap_units",
        f"concat('op_', {_pad('l_partkey % 40', 3)}) AS operator_id",
    )


def raw_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    return o.selectExpr(
        "concat('mnt_', cast(o_orderkey AS string)) AS maintenance_id",
        f"concat('mach_', {_pad('o_custkey div 14', 5)}) AS machine_id",
        f"{_iso('o_orderdate')} AS timestamp",
        "replace(substr(o_orderpriority, 3), ' ', '_') AS maintenance_type",
        "CASE o_orderstatus WHEN 'O' THEN 'none' WHEN 'F' THEN 'bearing' WHEN 'P' THEN 'motor' END "
        "AS part_replaced",
        "cast(floor(o_totalprice) AS bigint) % 125 - 5 AS downtime_minutes",
        "year(o_orderdate) AS year",
        "month(o_orderdate) AS month",
        "'0' AS _batch_id",
        "o_orderkey AS _row_seq",
    )


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records <- events: one run for each event, of the step its type
    names; an error event is a failed run."""
    ev = table(spark, sf_dir, "events").select("ts", "event_type")
    return ev.selectExpr(
        "cast(ts AS timestamp_ntz) AS timestamp",
        "event_type AS step",
        "CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status",
    )


RAW_BUILDERS = {
    "telemetry": raw_telemetry,
    "machines": raw_machines,
    "maintenance_logs": raw_maintenance,
    "production": raw_production,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}


def staged_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One staged table over its bound raw table."""
    from forgeline.operators import staging

    stagers = {
        "telemetry": staging.stage_telemetry,
        "machines": staging.stage_machines,
        "maintenance_logs": staging.stage_maintenance,
        "production": staging.stage_production,
    }
    return _cached(spark, ("staged", sf_dir, name),
                   lambda: stagers[name](_cached(spark, ("raw", sf_dir, name),
                                                 lambda: RAW_BUILDERS[name](spark, sf_dir))))


class StagedTables(dict):
    """Staged tables built on first use (a query pays only for what it reads).

    With ``materialize`` each table is written once as a table in the
    checkpoint folder when first used, as the staging job writes it to the
    lake: consumers that read a staged table several times (quality checks,
    alerts, dashboard counts) then plan and run over the written rows instead
    of re-deriving them in every branch.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False):
        super().__init__()
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize

    def __missing__(self, name: str) -> DataFrame:
        df = staged_table(self.spark, self.sf_dir, name)
        if self.materialize:
            df = materialize(df, f"staged-{name}")
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in RAW_BUILDERS

    def get(self, name, default=None):
        return self[name] if name in RAW_BUILDERS else default

    def keys(self):
        return list(RAW_BUILDERS)

    def items(self):
        return [(n, self[n]) for n in RAW_BUILDERS]

    def __iter__(self):
        return iter(RAW_BUILDERS)


def staged_tables(spark: SparkSession, sf_dir: str, materialize: bool = False) -> StagedTables:
    return StagedTables(spark, sf_dir, materialize)
