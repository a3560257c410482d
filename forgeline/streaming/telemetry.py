"""Telemetry landing with Structured Streaming.

JSON-lines files arriving in a landing folder are read as a file stream
(declared schema, FAILFAST) and each micro-batch is written to the raw
telemetry table, partitioned by the event hour and by the micro-batch id.
The checkpoint records which files were taken, so a restart reads only new
files; a retried micro-batch has the same id and replaces only its own
partitions. Every event of every batch lands (the reference's per-flush file
counter can overwrite an earlier flush of the same hour).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forgeline.config import Lake
from forgeline.schemas import RAW_TELEMETRY
from forgeline.functions.time import time_partitions
from forgeline.sinks.files import write_batch_partitions

PARTITIONS = ["year", "month", "day", "hour", "_batch_id"]


def batch_label(epoch_id: int, stream_name: str) -> str:
    """Batch label: micro-batch id (orders the batches of one stream), then
    the stream name, so two streams feeding one table never share a label
    (a shared label would let one stream's retry overwrite the other's)."""
    return f"e{epoch_id:012d}-{stream_name}"


def stream_name_of(landing_dir: str) -> str:
    return hashlib.sha1(landing_dir.rstrip("/").encode()).hexdigest()[:12]


def land_batch(lake: Lake, stream_name: str = "telemetry", stats: dict | None = None):
    """foreachBatch function; with ``stats`` it adds the events, batches and
    partitions written (``events``, ``batches``, ``partitions``) and the last
    batch label (``batch_id``). Events and
    partitions are observed by the write itself, so the batch is read once."""
    def _land(batch: DataFrame, epoch_id: int) -> None:
        ts = F.to_timestamp_ntz("timestamp")
        out = batch.withColumns({
            "_row_seq": F.monotonically_increasing_id(),
            **time_partitions(ts, with_day_hour=True),
            "_batch_id": F.lit(batch_label(epoch_id, stream_name)),
        })
        # the hours of one batch: a small set, gathered by the write itself
        hours = F.size(F.collect_set(F.concat_ws("/", *PARTITIONS[:-1])))
        seen = write_batch_partitions(out, lake.raw_telemetry, PARTITIONS,
                                      metrics=[F.count(F.lit(1)).alias("events"), hours.alias("hours")])
        if stats is None:
            return
        events, hours = (int(seen.get(k) or 0) for k in ("events", "hours"))
        stats["events"] = stats.get("events", 0) + events
        stats["batches"] = stats.get("batches", 0) + (events > 0)
        stats["partitions"] = stats.get("partitions", 0) + hours
        stats["batch_id"] = batch_label(epoch_id, stream_name)
    return _land


def telemetry_stream(spark: SparkSession, landing_dir: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_TELEMETRY).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(landing_dir)
    return src.select(
        "*",
        F.unix_micros("_metadata.file_modification_time").alias("_src_mtime"),
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_offset"),
    )


def land_telemetry(spark: SparkSession, lake: Lake, landing_dir: str,
                   max_files_per_trigger: int | None = None, available_now: bool = True,
                   processing_time: str | None = None, checkpoint: str | None = None,
                   stats: dict | None = None) -> StreamingQuery:
    """Start the landing query. With ``available_now`` it takes every file
    present, in one or more micro-batches, and stops. One landing folder
    has one checkpoint (by default below the lake's metadata)."""
    name = stream_name_of(landing_dir)
    writer = (telemetry_stream(spark, landing_dir, max_files_per_trigger)
              .writeStream.foreachBatch(land_batch(lake, name, stats))
              .option("checkpointLocation", checkpoint or f"{lake.stream_checkpoint}/{name}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_telemetry(spark: SparkSession, lake: Lake, landing_dir: str,
                     max_files_per_trigger: int | None = None) -> dict:
    """Run the landing query to completion and report what it took: events,
    micro-batches, hour partitions written and the last batch label."""
    stats: dict = {}
    q = land_telemetry(spark, lake, landing_dir, max_files_per_trigger, stats=stats)
    q.awaitTermination()
    return {"source": landing_dir, "total_events": stats.get("events", 0), "total_batches": stats.get("batches", 0),
            "total_partitions_written": stats.get("partitions", 0), "batch_id": stats.get("batch_id")}
