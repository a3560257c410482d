"""Batch ingestion of machines, maintenance logs and daily production.

High-water marks live in a small state table (one row per saved mark,
partitioned by source; the newest counts). A source's mark is written only after its data,
and data is written under a batch id made from the mark that the batch starts
from, with dynamic partition overwrite: a crash between the two re-runs the batch, which replaces its
own partitions instead of duplicating them.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.config import Lake
from forgeline.operators.incremental import after_mark
from forgeline.schemas import RAW_MACHINES, RAW_MAINTENANCE, RAW_PRODUCTION, WATERMARK_STATE
from forgeline.functions.time import time_partitions
from forgeline.sinks.files import drop_stale_partitions, write_batch_partitions
from forgeline.sources.files import read_csv_by_name, read_or_none

log = logging.getLogger("forgeline.ingest")


def new_batch_id(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S")


def batch_after(mark: str | None) -> str:
    """Id of the batch that starts from ``mark``: a batch that is run again
    because its mark was not saved has the same id."""
    return f"after-{mark or ''}"


def load_marks(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """Current marks; one row per source, so collecting them is bounded."""
    state = state_table(spark, lake)
    if state is None:
        return {}
    return {r["source"]: r["mark"] for r in state.select("source", "mark").collect() if r["mark"]}


def save_mark(spark: SparkSession, lake: Lake, source: str, mark: str, batch_id: str) -> None:
    row = spark.createDataFrame(
        [(source, mark, batch_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))], WATERMARK_STATE)
    # appended: a stop in the middle of it leaves the marks saved before
    row.write.mode("append").partitionBy("source").parquet(lake.state)


def state_table(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The mark of each source that was saved last."""
    state = read_or_none(spark, lake.state)
    if state is None:
        return None
    newest = F.max(F.struct("updated_at", "mark", "batch_id")).alias("s")
    return state.groupBy("source").agg(newest).select("source", "s.mark", "s.batch_id", "s.updated_at")


def _write_observed(df: DataFrame, mark_col: str | None, path: str, partition_cols: list[str], run_again: str | None = None) -> dict:
    """``run_again`` is the batch id where it follows from the mark: what an
    earlier run of the batch, stopped before it saved its mark, wrote for
    months that the source no longer has is removed."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if mark_col:
        metrics.append(F.max(mark_col).alias("mark"))
    if run_again:
        values = [F.coalesce(F.col(c), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in partition_cols[:-1]]
        metrics.append(F.collect_set(F.concat_ws("/", *values)).alias("places"))  # the months of one batch
    seen = write_batch_partitions(df, path, partition_cols, metrics=metrics)
    if run_again and seen.get("rows"):
        drop_stale_partitions(df.sparkSession, path, partition_cols, run_again, seen["places"])
    return seen


def ingest_machines(spark: SparkSession, lake: Lake, source_dir: str, batch_id: str) -> int:
    """Append a full snapshot of the machines file (staging keeps the newest
    row per machine). A missing file is skipped with a warning."""
    df = read_csv_by_name(spark, f"{source_dir}/machines.csv", RAW_MACHINES)
    if df is None:
        log.warning("machines.csv not found, skipping")
        return 0
    stats = _write_observed(df.withColumn("_batch_id", F.lit(batch_id)), None,
                            lake.raw_machines, ["_batch_id"])
    return int(stats.get("rows", 0))


def ingest_maintenance(spark: SparkSession, lake: Lake, source_dir: str,
                       batch_id: str | None = None) -> dict:
    """Machines snapshot + maintenance logs newer than the mark, partitioned
    by (year, month) of the log time."""
    last = load_marks(spark, lake).get("maintenance_logs")
    # a snapshot of machines is no batch after a mark: each has its own time
    machines_rows = ingest_machines(spark, lake, source_dir, batch_id or new_batch_id())
    again = batch_after(last) if batch_id is None else None
    batch_id = batch_id or again
    logs = read_csv_by_name(spark, f"{source_dir}/maintenance_logs.csv", RAW_MAINTENANCE)
    rows, mark = 0, last
    if logs is None:
        log.warning("maintenance_logs.csv not found, skipping")
    else:
        new = after_mark(logs, "timestamp", last)
        ts = F.to_timestamp_ntz("timestamp")
        new = new.withColumns({**time_partitions(ts), "_batch_id": F.lit(batch_id)})
        stats = _write_observed(new, "timestamp", lake.raw_maintenance,
                                ["year", "month", "_batch_id"], again)
        rows = int(stats.get("rows", 0))
        if rows:
            mark = stats["mark"]
            save_mark(spark, lake, "maintenance_logs", mark, batch_id)
    return {"machines_rows": machines_rows, "maintenance_logs_rows": rows, "watermark": mark,
            "batch_id": batch_id}


def ingest_production(spark: SparkSession, lake: Lake, source_path: str,
                      batch_id: str | None = None) -> dict:
    """Production rows with ``date`` after the mark, partitioned by
    (year, month). A missing file fails, as in the reference."""
    last = load_marks(spark, lake).get("production")
    again = batch_after(last) if batch_id is None else None
    batch_id = batch_id or again
    df = read_csv_by_name(spark, source_path, RAW_PRODUCTION)
    if df is None:
        raise FileNotFoundError(source_path)
    new = after_mark(df, "date", last)
    d = F.to_date("date", "yyyy-MM-dd")
    new = new.withColumns({**time_partitions(d), "_batch_id": F.lit(batch_id)})
    stats = _write_observed(new, "date", lake.raw_production, ["year", "month", "_batch_id"], again)
    rows = int(stats.get("rows", 0))
    if not rows:
        return {"rows": 0, "watermark": last, "batch_id": batch_id}
    save_mark(spark, lake, "production", stats["mark"], batch_id)
    return {"rows": rows, "watermark": stats["mark"], "batch_id": batch_id}
