"""Telemetry silence as a stream: which machines fell silent or came back,
found from each machine's last event time alone.

The landing folder is read as a file stream and grouped by machine. The state
of a machine is its last event time and whether it is silent; a timer stands
at the first millisecond at which it will have been silent for too long. A
newer event moves the timer, the watermark passing it makes the machine silent.
Nothing is aggregated again: a run costs its new events and the timers that ran out.

The clock is the newest event time of any machine. Rows of a clock folder
(JSON lines with a ``timestamp``) move it on when no machine sends at all.
The watermark runs ``lateness_hours`` behind the clock, so that an event that
arrives late still counts; as the state is one row for each machine, a long
lateness costs nothing, and timers are set by the clock, not by the watermark.

Changes are appended to a table (``machine_id, status, last_event, change``);
``change`` counts a machine's changes. ``silent_machines`` reads it and gives
the rows that ``operators.alerts.telemetry_silence_items`` gives over all events.

Limits: an event that arrives more than ``lateness_hours`` after the clock
passed its time is not seen; an event that was sent again with an *earlier* time does not take
back the later one (keep-last staging would); events without a time are
passed over; a machine that was silent and back within one batch does not change.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from forgeline import config as C
from forgeline.config import Lake
from forgeline.functions.time import hours_between, ts_literal
from forgeline.operators.staging import prepare_telemetry
from forgeline.plans.joins import lookup_join
from forgeline.streaming.telemetry import stream_name_of, telemetry_stream

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
CHANGE = "machine_id string, status string, last_event timestamp_ntz, change long"
LATENESS_HOURS = 7 * 24.0
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


class SilenceTracker(StatefulProcessor):
    """Input rows have ``millis`` (null: a row of the clock)."""

    def __init__(self, limit_millis: int, lateness_millis: int):
        self.limit, self.lateness = limit_millis, lateness_millis

    def _timer(self, millis: int) -> int:
        """Watermark at which a machine last heard at ``millis`` is silent."""
        return millis + self.limit + 1 - self.lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "millis long, silent boolean, change long")

    def _changed(self, key, millis: int, silent: bool, change: int):
        import pandas as pd

        self.seen.update((millis, silent, change))
        return pd.DataFrame({"machine_id": [key[0]], "status": [C.SILENT if silent else C.ACTIVE], "millis": [millis], "change": [change]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        newest = None
        for part in rows:  # batches of the machine's rows, never all at once
            top = part["millis"].max()
            if top == top and top is not None:
                newest = int(top) if newest is None else max(newest, int(top))
        if newest is None:
            return
        known = self.seen.get() if self.seen.exists() else None
        if known is not None and newest <= known[0]:
            return
        if known is not None and not known[1]:
            self.handle.deleteTimer(self._timer(known[0]))
        silent = self._timer(newest) <= timerValues.getCurrentWatermarkInMs()
        if not silent:
            self.handle.registerTimer(self._timer(newest))
        if known is None or known[1] != silent or silent:  # also a silent machine's later last event
            yield self._changed(key, newest, silent, known[2] + 1 if known else 1)
        else:
            self.seen.update((newest, silent, known[2]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        millis, silent, change = self.seen.get()
        if not silent and self._timer(millis) == expiredTimerInfo.getExpiryTimeInMs():
            yield self._changed(key, millis, True, change + 1)

    def close(self) -> None:
        pass


def silence_changes(events: DataFrame, silence_hours: float = C.TELEMETRY_SILENCE_HOURS, lateness_hours: float = LATENESS_HOURS) -> DataFrame:
    """The changes of a stream with machine_id, timestamp (zone-less) and
    ``clock`` (true: moves the clock only). Needs the RocksDB state store."""
    millis = F.expr(f"timestampdiff(MILLISECOND, {_EPOCH}, timestamp)")
    rows = events.where(F.col("timestamp").isNotNull()).select(
        "machine_id", F.when(~F.col("clock"), millis).alias("millis"),
        F.timestamp_millis(millis).alias("at")).withWatermark("at", f"{round(lateness_hours * 3_600_000)} milliseconds")
    out = rows.groupBy("machine_id").transformWithStateInPandas(
        SilenceTracker(round(silence_hours * 3_600_000), round(lateness_hours * 3_600_000)), "machine_id string, status string, millis long, change long",
        outputMode="append", timeMode="EventTime")
    return out.select("machine_id", "status", F.expr(f"timestampadd(MILLISECOND, millis, {_EPOCH})").alias("last_event"), "change")


def follow_silence(spark: SparkSession, lake: Lake, landing_dir: str, clock_dir: str | None = None,
                   silence_hours: float = C.TELEMETRY_SILENCE_HOURS, lateness_hours: float = LATENESS_HOURS,
                   max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the query that appends changes to ``lake.silence_changes``. One
    landing folder has one checkpoint; its state store is set for this query's start."""
    events = prepare_telemetry(telemetry_stream(spark, landing_dir, max_files_per_trigger)).select(
        "machine_id", "timestamp", F.lit(False).alias("clock"))
    if clock_dir:
        ticks = prepare_telemetry(telemetry_stream(spark, clock_dir)).select(
            "machine_id", "timestamp", F.lit(True).alias("clock"))
        events = events.unionByName(ticks)
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        writer = (silence_changes(events, silence_hours, lateness_hours).writeStream.outputMode("append").format("parquet")
                  .option("path", lake.silence_changes)
                  .option("checkpointLocation", f"{lake.silence_checkpoint}/{stream_name_of(landing_dir)}"))
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:  # a started query keeps the settings it was started with
        if before is None:
            spark.conf.unset(STATE_STORE[0])
        else:
            spark.conf.set(STATE_STORE[0], before)


def current_status(changes: DataFrame) -> DataFrame:
    """machine_id, status, last_event: the last change of each machine. Of an
    active machine ``last_event`` is the one that made it active."""
    last = F.max_by(F.struct("status", "last_event"), "change").alias("last")
    return changes.groupBy("machine_id").agg(last).select("machine_id", "last.status", "last.last_event")


def silent_machines(changes: DataFrame, machines: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Machines of the dimension that are silent or never sent, in the form of
    ``telemetry_silence_items``; ``as_of`` is where the stream's clock stands."""
    ids = machines.select("machine_id").distinct()
    found = lookup_join(ids, current_status(changes), "machine_id", null_safe=True)
    found = found.where(F.coalesce(F.col("status"), F.lit(C.NO_DATA)) != C.ACTIVE)
    return found.select("machine_id", "last_event", F.round(hours_between(F.col("last_event"), ts_literal(as_of)), 1).alias("hours_since"))
