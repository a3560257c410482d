"""Parameters of the platform: thresholds, reference time and lake layout.

The reference hard-codes these as module constants and reads the wall clock;
here they are arguments so every result is reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference's for the same results.
TEMP_THRESHOLD_C = 85.0          # temperature exceedance alert / abnormal machine
TEMP_CRITICAL_C = 95.0           # alert severity becomes critical above this
SCRAP_RATE_THRESHOLD = 0.05      # scrap rate spike alert / high scrap machine
TELEMETRY_SILENCE_HOURS = 1.0    # machine is silent after this many hours
LATE_DATA_HOURS = 2.0            # maintenance mark older than this is late
FAILED_RUN_WINDOW_HOURS = 24     # pipeline failure look-back
TREND_AVG_TEMP_C = 75.0          # trending toward failure: mean temperature
TREND_AVG_VIBRATION = 3.0        # trending toward failure: mean vibration
TREND_MAX_TEMP_C = 90.0          # trending toward failure: peak temperature
OVERHEAT_TEMP_C = 85.0           # overheating before shutdown: hot reading
SHUTDOWN_STATUSES = ("idle", "off", "error")
DANGER_TEMP_C = 90.0             # dashboard: danger class above this
CV_ABNORMAL = 0.15               # production variability: abnormal above this
TOP_N = 10                       # length of top lists and samples
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
PARTITION_COLUMNS = ("year", "month", "day", "hour")

# Labels of the reference's reports and data sets.
INFO, WARNING, ERROR, CRITICAL = "info", "warning", "error", "critical"
CHECK_NAMES = ("missing_telemetry", "negative_production", "machine_id_mismatch", "null_critical_fields")
ALERT_TYPES = ("telemetry_silence", "temperature_exceedance", "scrap_rate_spike", "late_data", "pipeline_failure")
ACTIVE, SILENT, NO_DATA = "active", "silent", "no_data"
DANGER, WARN = "danger", "warn"
SUCCESS = "success"
FAILURE = "failure"

# Report and alert texts as in the reference, but that unknown ids are
# given by number (their table holds them) and null counts by table name.
# Placeholders in braces are filled from data or parameters.
MSG_NO_STAGED = "No staged {what} data found"
MSG_TOO_FEW_EVENTS = "Too few events to check gaps"
MSG_GAPS = "{missing} missing event(s) in sequence. Sample: evt_{first}..evt_{last}"
MSG_NO_GAPS = "No gaps in telemetry event sequence"
MSG_NEGATIVES = "{units} negative units_produced, {scrap} negative scrap_units"
MSG_NO_NEGATIVES = "No negative production values"
MSG_UNKNOWN_IDS = "Unknown machine_ids — {entries}"
MSG_IDS_MATCH = "All machine_ids match the machines dimension"
MSG_NULLS = "Nulls found: {entries}"
MSG_NO_NULLS = "No nulls in critical fields"
MSG_SILENCE = "{n} machine(s) have not sent telemetry in {hours}h"
MSG_TEMPERATURE = "{n} machine(s) exceeded {threshold}°C temperature threshold"
MSG_SCRAP = "{n} machine(s) exceed {percent}% scrap rate threshold"
MSG_MAINTENANCE_LATE = "Maintenance data is {hours}h old (threshold: {limit}h)"
MSG_PRODUCTION_LATE = "Production data is {days} day(s) behind"
MSG_FAILURES = "{n} pipeline step(s) failed in the last {hours}h"

# Reference time for the driver's test tables (events end on 2024-01-30).
DEFAULT_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


@dataclass(frozen=True)
class Thresholds:
    temp_c: float = TEMP_THRESHOLD_C
    temp_critical_c: float = TEMP_CRITICAL_C
    scrap_rate: float = SCRAP_RATE_THRESHOLD
    silence_hours: float = TELEMETRY_SILENCE_HOURS
    late_data_hours: float = LATE_DATA_HOURS
    failed_run_hours: int = FAILED_RUN_WINDOW_HOURS


@dataclass(frozen=True)
class Lake:
    """Table locations below one root URI (``file:/...``, ``s3a://...``)."""

    root: str
    tables: dict = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # raw layer (append only)
    @property
    def raw_telemetry(self) -> str:
        return self.path("raw", "telemetry")

    @property
    def raw_machines(self) -> str:
        return self.path("raw", "maintenance", "machines")

    @property
    def raw_maintenance(self) -> str:
        return self.path("raw", "maintenance", "maintenance_logs")

    @property
    def raw_production(self) -> str:
        return self.path("raw", "production")

    def compacted(self, name: str) -> str:
        return self.path("raw_compacted", name)

    # staging / analytics (rewritten each run)
    def staging(self, name: str) -> str:
        return self.path("staging", name)

    def staging_checkpoint(self, name: str) -> str:
        return self.path("metadata", "checkpoints", "staging", name)

    def analytics(self, name: str) -> str:
        return self.path("analytics", name)

    # metadata
    @property
    def state(self) -> str:
        return self.path("metadata", "watermarks")

    @property
    def run_history(self) -> str:
        return self.path("metadata", "runs")

    @property
    def lineage(self) -> str:
        return self.path("metadata", "lineage")

    @property
    def quality_report(self) -> str:
        return self.path("metadata", "quality")

    @property
    def alert_report(self) -> str:
        return self.path("metadata", "alerts")

    @property
    def silence_changes(self) -> str:
        return self.path("metadata", "silence")

    @property
    def silence_checkpoint(self) -> str:
        return self.path("metadata", "checkpoints", "silence")

    @property
    def stream_checkpoint(self) -> str:
        return self.path("metadata", "checkpoints", "telemetry")
