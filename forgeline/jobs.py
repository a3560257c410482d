"""Stage runner: each stage reads lake tables, builds one lazy plan per
output and ends in a write. Every stage records a run (time, status, rows)
and its lineage (inputs, outputs, row counts). Written tables cut lineage
between stages."""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline import config as C
from forgeline import incremental as INC
from forgeline.compaction import compact_telemetry, compacted_rows
from forgeline.config import Lake
from forgeline.ingest import ingest_maintenance, ingest_production, state_table
from forgeline.operators import alerts as A
from forgeline.operators import facts as FT
from forgeline.operators import metrics as M
from forgeline.operators import partials as P
from forgeline.operators import quality as Q
from forgeline.operators import serving as S
from forgeline.operators import staging as ST
from forgeline.operators import warehouse as W
from forgeline.schemas import ALERT, LINEAGE_RECORD, RUN_RECORD
from forgeline.sinks.files import append_log, overwrite_table, write_report
from forgeline.sinks.versions import VersionedTable
from forgeline.sources.files import path_exists, read_or_none, read_raw_parquet
from forgeline.streaming.telemetry import ingest_telemetry

log = logging.getLogger("forgeline.jobs")

def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _meta(d: dict | None) -> dict:
    return {str(k): json.dumps(v) if not isinstance(v, str) else v for k, v in (d or {}).items()}


# -- run history and lineage ---------------------------------------------------

def record_run(spark: SparkSession, lake: Lake, step: str, *, status: str = "success", rows: int = 0,
               duration_seconds: float = 0.0, error: str | None = None, metadata: dict | None = None,
               at: dt.datetime | None = None) -> dict:
    rec = (at or _now(), step, status, int(rows), round(float(duration_seconds), 3), error, _meta(metadata))
    append_log(spark.createDataFrame([rec], RUN_RECORD), lake.run_history)
    return dict(zip(RUN_RECORD.fieldNames(), rec))


def run_history(spark: SparkSession, lake: Lake, step: str | None = None) -> DataFrame:
    df = read_or_none(spark, lake.run_history, "json", schema=RUN_RECORD)
    if df is None:
        return spark.createDataFrame([], RUN_RECORD)
    df = df.where(F.col("step") == step) if step is not None else df
    return df.orderBy("timestamp")


def failed_runs(spark: SparkSession, lake: Lake, as_of: dt.datetime,
                since_hours: int = C.FAILED_RUN_WINDOW_HOURS) -> DataFrame:
    return A.failed_run_items(run_history(spark, lake), as_of, since_hours)


def record_lineage(spark: SparkSession, lake: Lake, step: str, inputs: list[str], outputs: list[str],
                   input_rows: int = 0, output_rows: int = 0, metadata: dict | None = None) -> dict:
    rec = (_now(), step, list(inputs), list(outputs), int(input_rows), int(output_rows), _meta(metadata))
    append_log(spark.createDataFrame([rec], LINEAGE_RECORD), lake.lineage)
    return dict(zip(LINEAGE_RECORD.fieldNames(), rec))


def lineage(spark: SparkSession, lake: Lake) -> DataFrame:
    df = read_or_none(spark, lake.lineage, "json", schema=LINEAGE_RECORD)
    return spark.createDataFrame([], LINEAGE_RECORD) if df is None else df.orderBy("timestamp")


class Run:
    """What a recorded task has done so far: ``done`` adds rows to its record."""

    def __init__(self, step: str):
        self.step, self.rows, self.begun = step, 0, time.perf_counter()

    def done(self, rows: int) -> None:
        self.rows += rows

    @property
    def seconds(self) -> float:
        return time.perf_counter() - self.begun


@contextmanager
def recorded(spark: SparkSession, lake: Lake, step: str) -> Iterator[Run]:
    """Leaves one run record behind, whether the block ends or fails."""
    run, outcome = Run(step), {"status": C.SUCCESS}
    try:
        yield run
    except Exception as exc:
        outcome = {"status": C.FAILURE, "error": str(exc)}
        raise
    finally:
        record_run(spark, lake, step, rows=run.rows if outcome["status"] == C.SUCCESS else 0, duration_seconds=run.seconds, **outcome)


# -- stages --------------------------------------------------------------------

def _write_counted(df: DataFrame, path: str, name: str) -> int:
    obs = Observation(name)
    overwrite_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path)
    return int(obs.get.get("rows", 0))


RAW_PATHS = {
    "telemetry": lambda lake: lake.raw_telemetry,
    "machines": lambda lake: lake.raw_machines,
    "maintenance_logs": lambda lake: lake.raw_maintenance,
    "production": lambda lake: lake.raw_production,
}


def run_staging(spark: SparkSession, lake: Lake, full: bool = False) -> dict:
    """Merge the raw files that are new into the staged tables (``full``:
    stage the whole history anew). Machines, a dimension, is staged whole."""
    stats = {}
    for name, path_of in RAW_PATHS.items():
        out = lake.staging(name)
        if not path_exists(spark, path_of(lake)):
            log.warning("no raw %s data found", name)
            stats[name] = 0
            continue
        if name not in INC.SPECS:
            stats[name] = _write_counted(ST.stage_machines(read_raw_parquet(spark, path_of(lake))), out, f"stage_{name}")
        elif full:
            INC.rebuild(spark, path_of(lake), out, INC.SPECS[name], compacted_rows(spark, lake, name))
            stats[name] = INC.staged_rows(VersionedTable(spark, out))
        else:
            stats[name] = INC.stage_new_files(spark, path_of(lake), out, lake.staging_checkpoint(name), INC.SPECS[name])
        record_lineage(spark, lake, f"staging.{name}", [path_of(lake)], [out], output_rows=stats[name])
    return stats


def _staged(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    return read_or_none(spark, lake.staging(name))


def run_analytics(spark: SparkSession, lake: Lake) -> dict:
    """Each table is built only when its inputs exist (as in the reference)."""
    tel, mach = _staged(spark, lake, "telemetry"), _staged(spark, lake, "machines")
    maint, prod = _staged(spark, lake, "maintenance_logs"), _staged(spark, lake, "production")
    plans: dict[str, tuple[Callable[[], DataFrame], list[str]]] = {}
    if tel is not None and mach is not None:
        plans["fact_machine_events"] = (lambda: FT.fact_machine_events(tel, mach), ["telemetry", "machines"])
    if prod is not None and mach is not None:
        plans["fact_production"] = (lambda: FT.fact_production(prod, mach), ["production", "machines"])
    if maint is not None and mach is not None:
        plans["fact_maintenance"] = (lambda: FT.fact_maintenance(maint, mach), ["maintenance_logs", "machines"])
        plans["fact_downtime"] = (lambda: FT.fact_downtime(maint, mach), ["maintenance_logs", "machines"])
    def merged(table, side, merge, whole):
        """From the partial metrics of the staged parts; over the rows where a table has none."""
        partials = INC.side_table(VersionedTable(spark, lake.staging(table)), side)
        return whole() if partials is None else merge(partials)

    if tel is not None:
        plans["machine_health_features"] = (
            lambda: merged("telemetry", "health", P.merge_health, lambda: M.machine_health_features(tel)), ["telemetry"])
    if maint is not None and mach is not None:
        plans["factory_downtime_metrics"] = (
            lambda: merged("maintenance_logs", "downtime", lambda p: P.merge_downtime(p, mach),
                           lambda: M.factory_downtime_metrics(read_or_none(spark, lake.analytics("fact_downtime")))),
            ["maintenance_logs", "machines"])
    if prod is not None and mach is not None:
        plans["scrap_rate_metrics"] = (
            lambda: merged("production", "scrap", P.merge_scrap, lambda: M.scrap_rate_metrics(prod)), ["production"])
    if maint is not None:
        plans["maintenance_effectiveness_metrics"] = (
            lambda: merged("maintenance_logs", "effectiveness", P.merge_effectiveness,
                           lambda: M.maintenance_effectiveness_metrics(maint)), ["maintenance_logs"])
    built = []
    for name, (make, inputs) in plans.items():
        out = lake.analytics(name)
        rows = _write_counted(make(), out, name)
        record_lineage(spark, lake, f"analytics.{name}", inputs, [out], output_rows=rows)
        built.append(name)
    return {"tables": built}


class QualityCheckError(Exception):
    def __init__(self, row: dict):
        self.result = row
        super().__init__(f"Quality check FAILED [{row['check_name']}]: {row['details']} "
                         f"({row['records_failed']}/{row['records_checked']} records)")


def staged_profiles(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The counts that staging kept with its parts, in the form the checks take."""
    out = {}
    for name, fields in Q.CRITICAL_FIELDS.items():
        found = INC.table_profile(VersionedTable(spark, lake.staging(name)))
        if found is not None:
            negative = [c for c in ("neg_units", "neg_scrap") if c in found.columns]
            out[name] = found.select("rows", *[F.col(f"null_{c}").alias(f"n{i}") for i, c in enumerate(fields)], *negative)
    return out


def run_quality(spark: SparkSession, lake: Lake, fail_early: bool = True) -> list[dict]:
    """All checks into one report (written), summary included. With
    ``fail_early`` the first failed error-severity check raises after the
    report up to it is saved. The report has four rows, so it is collected."""
    staged = {n: _staged(spark, lake, n) for n in ("telemetry", "production", "maintenance_logs", "machines")}
    report = Q.quality_report(staged["telemetry"], staged["production"], staged["maintenance_logs"],
                              staged["machines"], spark=spark, profiles=staged_profiles(spark, lake))
    sources = {n: df for n, df in staged.items() if n != "machines" and df is not None}
    if staged["machines"] is not None and sources:
        overwrite_table(Q.unknown_machine_ids(staged["machines"], sources), lake.path("metadata", "unknown_machine_ids"))
    rows = [r.asDict() for r in report.orderBy("check_order").collect()]
    blocking = [r for r in rows if not r["passed"] and r["severity"] == C.ERROR][:1] if fail_early else []
    if blocking:  # what would have come after it is not reported
        rows = rows[:rows.index(blocking[0]) + 1]
    report_df = spark.createDataFrame(rows, report.schema)
    summary = Q.quality_summary(report_df).first().asDict()
    write_report(report_df.withColumn("run_timestamp", F.lit(_now()))
                 .withColumns({f"summary_{k}": F.lit(v) for k, v in summary.items()}), lake.quality_report)
    record_lineage(spark, lake, "quality.checks", [lake.staging("*")], [lake.quality_report],
                   output_rows=len(rows))
    if blocking:
        raise QualityCheckError(blocking[0])
    return rows


def run_alerts(spark: SparkSession, lake: Lake, as_of: dt.datetime,
               thresholds: C.Thresholds = C.Thresholds()) -> list[dict]:
    """Alert headers (report) and per-machine items (one table per alert
    type). A failing check is logged and skipped, as in the reference."""
    tel, mach = _staged(spark, lake, "telemetry"), _staged(spark, lake, "machines")
    health = read_or_none(spark, lake.analytics("machine_health_features"))
    scrap = read_or_none(spark, lake.analytics("scrap_rate_metrics"))
    state = state_table(spark, lake)
    rows: list[dict] = []

    def guarded(name, items_of, header_of):
        """Each check is evaluated in here, so one that fails loses no other's alert."""
        path = lake.path("metadata", "alerts_items", name)
        try:
            items = items_of()
            if name != "late_data":  # its items are the alerts themselves
                overwrite_table(items, path)
                items = spark.read.schema(items.schema).parquet(path)
            found = header_of(items).select(*A.HEADER_COLUMNS).collect()  # a few rows
            rows.extend({**r.asDict(), "alert_order": order} for r in found)
        except Exception:  # noqa: BLE001 - reference logs and goes on
            log.exception("alert check %s failed", name)

    checks = [
        ("telemetry_silence", tel is not None and mach is not None,
         lambda: A.telemetry_silence_items(tel, mach, as_of, thresholds.silence_hours),
         lambda items: A.telemetry_silence_alert(items, thresholds.silence_hours)),
        ("temperature_exceedance", health is not None,
         lambda: A.temperature_items(health, thresholds.temp_c),
         lambda items: A.temperature_alert(items, thresholds.temp_c, thresholds.temp_critical_c)),
        ("scrap_rate_spike", scrap is not None,
         lambda: A.scrap_items(scrap, thresholds.scrap_rate),
         lambda items: A.scrap_alert(items, thresholds.scrap_rate)),
        ("late_data", state is not None,
         lambda: A.late_data_alerts(state, as_of, thresholds.late_data_hours), lambda items: items),
        ("pipeline_failure", True,
         lambda: failed_runs(spark, lake, as_of, thresholds.failed_run_hours),
         lambda items: A.pipeline_failure_alert(items, thresholds.failed_run_hours)),
    ]
    for order, (name, present, items_of, header_of) in enumerate(checks):
        if present:
            guarded(name, items_of, header_of)
    schema = T.StructType([*[f for f in ALERT.fields if f.name in A.HEADER_COLUMNS], T.StructField("alert_order", T.IntegerType())])
    report_df = spark.createDataFrame(rows, schema)
    totals = A.alert_summary(report_df).first().asDict()
    write_report(report_df.withColumn("timestamp", F.lit(_now()))
                 .withColumns({k: F.lit(v) for k, v in totals.items()}), lake.alert_report)
    return rows


BUSINESS_QUERIES = {
    "machines_trending_toward_failure": (lambda t: W.machines_trending_toward_failure(t["health"]), ["health"]),
    "overheating_before_shutdown": (lambda t: W.overheating_before_shutdown(t["telemetry"]), ["telemetry"]),
    "frequently_failing_machines": (lambda t: W.frequently_failing_machines(t["fact_maintenance"]),
                                    ["fact_maintenance"]),
    "downtime_by_factory": (lambda t: W.downtime_by_factory(t["factory"]), ["factory"]),
    "maintenance_reducing_downtime": (lambda t: W.maintenance_reducing_downtime(t["effectiveness"]),
                                      ["effectiveness"]),
    "machines_high_scrap": (lambda t: W.machines_high_scrap(t["scrap"]), ["scrap"]),
    "lines_abnormal_variability": (lambda t: W.lines_abnormal_variability(t["production"]), ["production"]),
}


def run_queries(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Answer the seven questions into ``serving/<name>``; a failing query
    gives 0 rows and the others go on."""
    t = {
        "health": read_or_none(spark, lake.analytics("machine_health_features")),
        "telemetry": _staged(spark, lake, "telemetry"),
        "fact_maintenance": read_or_none(spark, lake.analytics("fact_maintenance")),
        "factory": read_or_none(spark, lake.analytics("factory_downtime_metrics")),
        "effectiveness": read_or_none(spark, lake.analytics("maintenance_effectiveness_metrics")),
        "scrap": read_or_none(spark, lake.analytics("scrap_rate_metrics")),
        "production": _staged(spark, lake, "production"),
    }
    out = {}
    for name, (build, needs) in BUSINESS_QUERIES.items():
        if any(t[n] is None for n in needs):
            out[name] = 0
            continue
        try:
            out[name] = _write_counted(build(t), lake.path("serving", name), name)
        except Exception:  # noqa: BLE001
            log.exception("query %s failed", name)
            out[name] = 0
    return out


def run_serving(spark: SparkSession, lake: Lake, as_of: dt.datetime, thresholds: C.Thresholds = C.Thresholds()) -> dict[str, int]:
    """The dashboard's data sets, each a table below ``serving``: the status
    of every machine (``no_data`` for all while there is no telemetry), the header
    counts, the three top-ten lists and the downtime list, as far as their
    inputs exist; and JSON extracts of the metric tables. They read the written
    metric tables and the status table just written, not the rows again."""
    tel, mach = _staged(spark, lake, "telemetry"), _staged(spark, lake, "machines")
    tables = {n: read_or_none(spark, lake.analytics(n)) for n in ("factory_downtime_metrics", "machine_health_features", "scrap_rate_metrics")}
    downtime, health, scrap = tables.values()
    out = {}

    def serve(name: str, df: DataFrame) -> DataFrame:
        out[name] = _write_counted(df, lake.path("serving", name), name)
        return read_or_none(spark, lake.path("serving", name))

    status = None
    if mach is not None:
        latest = INC.side_table(VersionedTable(spark, lake.staging("telemetry")), "latest")
        latest = P.merge_latest(latest) if latest is not None else None if tel is None else M.latest_event_per_machine(tel)
        status = serve("telemetry_status", S.status_of(latest, mach, as_of, thresholds.silence_hours))
        serve("dashboard_silent", S.dashboard_silent(status))
    if health is not None:
        serve("dashboard_abnormal", S.dashboard_abnormal(health, temp_threshold=thresholds.temp_c))
    if scrap is not None:
        serve("dashboard_high_scrap", S.dashboard_high_scrap(scrap, threshold=thresholds.scrap_rate))
    if downtime is not None:
        serve("dashboard_downtime", S.dashboard_downtime(downtime))
    alerts = read_or_none(spark, lake.alert_report, "json", schema=ALERT_TOTALS)
    totals = alerts if alerts is not None else spark.createDataFrame([], ALERT_TOTALS)
    serve("dashboard_kpis", S.dashboard_kpis(spark, downtime, health, status, scrap, totals.agg(F.max("total_alerts").alias("total_alerts")),
                                             thresholds.temp_c, thresholds.scrap_rate))
    for name, table in tables.items():
        if table is not None:
            obs = Observation(f"extract_{name}")
            table.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(lake.path("serving", "extracts", name))
            out[f"extract_{name}"] = int(obs.get.get("rows", 0))
    return out


# -- the whole run ---------------------------------------------------------------

ALERT_TOTALS = "total_alerts long"


@dataclass(frozen=True)
class Task:
    """A task of the run: its step, what it reads and writes (the order follows
    from that), and a function that does it and returns the rows it wrote."""

    name: str
    step: str
    reads: tuple[str, ...]
    writes: tuple[str, ...]
    run: Callable[[], int]


def tasks_of(spark: SparkSession, lake: Lake, source_dir: str, landing_dir: str, as_of: dt.datetime) -> list[Task]:
    return [
        Task("serving.status", "queries", ("staging", "analytics", "alerts"), ("serving",), lambda: sum(run_serving(spark, lake, as_of).values())),
        Task("warehouse.queries", "queries", ("staging", "analytics"), ("answers",), lambda: sum(run_queries(spark, lake).values())),
        Task("monitoring.alerts", "alerts", ("staging", "analytics", "quality"), ("alerts",), lambda: len(run_alerts(spark, lake, as_of))),
        Task("quality.checks", "quality", ("staging", "analytics"), ("quality",), lambda: len(run_quality(spark, lake, fail_early=False))),
        Task("transformations.analytics", "analytics", ("staging",), ("analytics",), lambda: len(run_analytics(spark, lake)["tables"])),
        Task("transformations.staging", "staging", ("raw telemetry", "raw maintenance", "raw production"), ("staging",),
             lambda: sum(run_staging(spark, lake).values())),
        Task("ingestion.compaction", "compaction", ("staging",), ("raw files",), lambda: compact_telemetry(spark, lake).files),
        Task("ingestion.telemetry", "ingest", (), ("raw telemetry",), lambda: ingest_telemetry(spark, lake, landing_dir)["total_events"]),
        Task("ingestion.maintenance", "ingest", (), ("raw maintenance",),
             lambda: ingest_maintenance(spark, lake, source_dir)["maintenance_logs_rows"]),
        Task("ingestion.production", "ingest", (), ("raw production",),
             lambda: ingest_production(spark, lake, f"{source_dir}/daily_production.csv")["rows"]),
    ]


def in_order(tasks: list[Task]) -> list[Task]:
    """Each task after those that write what it reads."""
    writer = {w: t.name for t in tasks for w in t.writes}
    by_name = {t.name: t for t in tasks}
    graph = {t.name: {writer[r] for r in t.reads if r in writer} for t in tasks}
    return [by_name[n] for n in TopologicalSorter(graph).static_order()]


def run_all(spark: SparkSession, lake: Lake, source_dir: str, landing_dir: str, as_of: dt.datetime,
            steps: list[str] | None = None) -> list[str]:
    """The whole run, or the tasks of some steps of it; a failed task is recorded
    and the run goes on. Returns the names of failed tasks."""
    failed = []
    for task in in_order(tasks_of(spark, lake, source_dir, landing_dir, as_of)):
        if steps is not None and task.step not in steps:
            continue
        try:
            with recorded(spark, lake, task.name) as run:
                run.done(task.run())
        except Exception:  # noqa: BLE001
            log.exception("task %s failed", task.name)
            failed.append(task.name)
    return failed
