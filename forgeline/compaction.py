"""Compaction of the raw table: hours that many small batches were landed in
become a few files, with every row and every column that orders it.

Files are moved in three steps. The files of crowded hours are listed; staging
then takes all new files, so that none is moved which it has not read; the
listed files are rewritten by hour into a versioned table beside the raw one, and
deleted once that is committed. A row keeps its batch, source file and place, so
keep-last decides as before. What stops half-way leaves the raw files, or rows that are
in both places: these are equal in key and order, and staging keeps one.

An hour that is crowded again is merged with what was moved before, so an hour has
at most ``over`` raw files and the few of the compacted table after a run.
The list of files is metadata of the driver, at most ``most_files`` of them in one run,
oldest hours first; the next run goes on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline import incremental as INC
from forgeline.config import Lake
from forgeline.sinks.versions import VersionedTable
from forgeline.sources.files import path_exists

OVER, MOST_FILES = 24, 50_000


@dataclass(frozen=True)
class Moved:
    hours: int
    files: int


def crowded_files(spark: SparkSession, raw_path: str, over: int = OVER, most_files: int = MOST_FILES) -> list[str]:
    """The files of hours with more than ``over`` of them. Only names are read."""
    names = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(raw_path).select("path", F.regexp_extract("path", "^(.*)/[^/]*/[^/]*$", 1).alias("hour")))
    hours = names.groupBy("hour").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > over).orderBy("hour").limit(most_files).collect()
    some, n = [], 0
    for h in hours:
        if some and n + h["n"] > most_files:
            break
        some.append((h["hour"],))
        n += h["n"]
    if not some:
        return []
    return [r["path"] for r in names.join(spark.createDataFrame(some, "hour string"), "hour").select("path").collect()]


def _hour(spec: INC.Staged) -> Column:
    cols = [f.name for f in spec.raw_schema][-spec.time_columns:]
    return F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit(INC.NO_PART)) for c in cols])


def move(spark: SparkSession, raw_path: str, table: VersionedTable, spec: INC.Staged, files: list[str]) -> Moved:
    """Rewrite raw files into the compacted table, commit, then delete them."""
    if not files:
        return Moved(0, 0)
    now = table.current()
    rows = spark.read.schema(spec.raw_schema).option("basePath", raw_path).parquet(*files).withColumn(INC.PART, _hour(spec))
    hours = [r[0] for r in rows.select(INC.PART).distinct().collect()]
    again = [h for h in hours if now and h in now.parts]
    if again:
        rows = rows.unionByName(table.read(again, every_column=True, version=now).withColumn(INC.PART, _hour(spec)))
    folder = table.new_folder("hours")
    rows.hint("rebalance", F.col(INC.PART)).write.partitionBy(INC.PART).parquet(table.full(folder))
    parts = (dict(now.parts) if now else {}) | {h: {"folder": INC.folder_of(spark, folder, h)} for h in hours}
    schema = T.StructType([f for f in rows.schema.fields if f.name != INC.PART])
    table.commit(parts, {"schema": schema.jsonValue()}, now)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(raw_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in files:
        fs.delete(fs_path(f), False)
    return Moved(len(hours), len(files))


def compacted_rows(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    return VersionedTable(spark, lake.compacted(name)).read(every_column=True)


def compact_telemetry(spark: SparkSession, lake: Lake, over: int = OVER, most_files: int = MOST_FILES) -> Moved:
    """List, stage, move."""
    spec, raw = INC.SPECS["telemetry"], lake.raw_telemetry
    if not path_exists(spark, raw):
        return Moved(0, 0)
    files = crowded_files(spark, raw, over, most_files)
    if files:
        INC.stage_new_files(spark, raw, lake.staging("telemetry"), lake.staging_checkpoint("telemetry"), spec)
    return move(spark, raw, VersionedTable(spark, lake.compacted("telemetry")), spec, files)
