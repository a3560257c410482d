"""Fact tables: staged data looked up against the machines dimension.

All lookups are left outer equi-joins on ``machine_id`` (unmatched rows keep
null attributes). The dimension is broadcast only behind a size check
(``forgeline.plans.joins.lookup_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions.numeric import safe_ratio
from forgeline.plans.joins import lookup_join


def _dim(machines: DataFrame, *cols: str) -> DataFrame:
    return machines.select("machine_id", *cols)


def fact_machine_events(telemetry: DataFrame, machines: DataFrame) -> DataFrame:
    """Telemetry + machine_type (the telemetry keeps its own factory_id)."""
    out = lookup_join(telemetry, _dim(machines, "machine_type"), "machine_id", bound_by=machines)
    return out.select(*telemetry.columns, "machine_type")


def fact_production(production: DataFrame, machines: DataFrame) -> DataFrame:
    out = lookup_join(production, _dim(machines, "factory_id"), "machine_id", bound_by=machines)
    return out.select(
        *production.columns, "factory_id",
        safe_ratio(F.col("scrap_units"), F.col("units_produced")).alias("scrap_rate"),
    )


def fact_maintenance(maintenance: DataFrame, machines: DataFrame) -> DataFrame:
    out = lookup_join(maintenance, _dim(machines, "factory_id", "machine_type"), "machine_id",
                      bound_by=machines)
    return out.select(*maintenance.columns, "factory_id", "machine_type")


def fact_downtime(maintenance: DataFrame, machines: DataFrame) -> DataFrame:
    """Maintenance rows with downtime > 0, + factory_id. The filter sits below
    the join so it reaches the scan."""
    down = maintenance.where(F.col("downtime_minutes") > 0)
    out = lookup_join(down, _dim(machines, "factory_id"), "machine_id", bound_by=machines)
    return out.select(*maintenance.columns, "factory_id")
