"""Plan inspection used by tests and by ``tools/plan_report.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "FlatMapCoGroupsInPandas", "MapInArrow", "FlatMapGroupsInArrow",
                "FlatMapCoGroupsInArrow", "TransformWithState")


def physical_plan(df: DataFrame) -> str:
    """The executed (pre-AQE) physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def python_nodes(df: DataFrame) -> list[str]:
    plan = physical_plan(df)
    return [n for n in PYTHON_NODES if n in plan]


def count_nodes(df: DataFrame, name: str) -> int:
    return physical_plan(df).count(name)
