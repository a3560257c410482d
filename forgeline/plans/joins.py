"""Lookup joins against a dimension.

A dimension is broadcast only when the optimizer's size estimate of its
plan is under ``max_broadcast_bytes``; beyond that the join is left to a
shuffle join (sort-merge), where adaptive execution may still switch to a
broadcast from the real size at run time and splits skewed partitions of
the fact side. Nothing is collected to the driver for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - Spark Connect has no JVM handle
        return None


#: answers of probes, by plan, limit and the optimizer's size of the plan: a table whose files grew is probed anew
_MEASURED: dict[tuple, bool] = {}


def _has_join(df: DataFrame) -> bool:
    try:
        return "Join" in df._jdf.queryExecution().analyzed().toString()
    except Exception:  # pragma: no cover - Spark Connect has no JVM handle
        return False


# bytes per value used to turn a byte limit into a row limit (UnsafeRow:
# 8 bytes per field; strings and nested values also take their payload)
_FIXED = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}


def row_width(df: DataFrame) -> int:
    """Rough in-memory bytes per row, generous for variable-length values."""
    width = 0
    for _, dtype in df.dtypes:
        width += 8 + (0 if dtype in _FIXED or dtype in ("bigint", "double", "timestamp", "timestamp_ntz")
                      or dtype.startswith("decimal") else 32)
    return max(width, 8)


def row_bound(base: DataFrame, max_rows: int) -> bool:
    """Whether ``base`` has at most ``max_rows`` rows (a probe that stops
    after ``max_rows + 1`` rows; kept per analyzed plan and size of its files for the session)."""
    try:
        key = ("rows", int(base._jdf.queryExecution().analyzed().semanticHash()), max_rows, estimated_size_bytes(base))
    except Exception:  # pragma: no cover - Spark Connect: no plan handle, no cache
        return base.limit(max_rows + 1).count() <= max_rows
    if key not in _MEASURED:
        _MEASURED[key] = base.limit(max_rows + 1).count() <= max_rows
    return _MEASURED[key]


def fits_broadcast(dim: DataFrame, limit: int, bound_by: DataFrame | None = None) -> bool:
    """Whether ``dim`` is at most ``limit`` bytes.

    The optimizer's estimate is used when the dimension's plan is scans,
    filters, projections and aggregates (a fresh estimate each time, since
    the files below it can change). With a join inside, Spark (without CBO
    statistics) estimates the product of the join's inputs, far above the
    real size of a lookup (N:1) join; then the rows are counted by a probe
    that stops after ``limit / row width`` rows, and the answer is kept per
    plan and size of its files for the session.
    """
    if bound_by is not None and _has_join(dim):
        # dim is a projection / filter / distinct of bound_by: no more rows
        return row_bound(bound_by, max(1, limit // row_width(dim)))
    if _has_join(dim):  # implies a JVM handle
        est = estimated_size_bytes(dim)
        key = (int(dim._jdf.queryExecution().analyzed().semanticHash()), limit, est)
        if key not in _MEASURED:
            if est is not None and est <= limit:
                _MEASURED[key] = True
            else:
                max_rows = max(1, limit // row_width(dim))
                _MEASURED[key] = dim.limit(max_rows + 1).count() <= max_rows
        return _MEASURED[key]
    est = estimated_size_bytes(dim)
    return est is not None and est <= limit


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    raw = conf.get("forgeline.maxBroadcastBytes", None)
    return int(raw) if raw else DEFAULT_MAX_BROADCAST_BYTES


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left",
                max_broadcast_bytes: int | None = None, null_safe: bool = False,
                bound_by: DataFrame | None = None) -> DataFrame:
    """Join ``fact`` to ``dim`` on key column(s) ``on`` (same name both sides).

    ``how`` is ``left`` (keep every fact row; unmatched gets null attributes),
    ``inner`` or ``left_anti``. With ``null_safe`` a null key matches a null
    key, as a Python dict lookup would. ``bound_by`` names a table that
    ``dim`` is a projection, filter or distinct of (so it has no more rows);
    its row count is probed once and shared by all such dimensions.
    """
    keys = [on] if isinstance(on, str) else list(on)
    limit = broadcast_limit(dim) if max_broadcast_bytes is None else max_broadcast_bytes
    right = F.broadcast(dim) if fits_broadcast(dim, limit, bound_by) else dim
    if not null_safe:
        return fact.join(right, keys, how)
    renamed = right.select(*[F.col(c).alias(f"__dim_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        term = fact[k].eqNullSafe(renamed[f"__dim_{k}"])
        cond = term if cond is None else cond & term
    out = fact.join(renamed, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi"):
        return out
    return out.drop(*[f"__dim_{k}" for k in keys])
