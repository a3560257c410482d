"""Incremental staging: a run reads the raw files that are new and rewrites
only the staged days that they can touch.

A staged table is a versioned table (``sinks.versions``) with one part for
each day (telemetry) or month (maintenance) of its rows, or each raw batch
partition (production, which has no key). Beside its rows a part has

* an index: the range of its keys and a Bloom filter of them (``operators.bloom``);
* a profile: named counts that the quality checks read instead of the rows;
* partial metrics: sums, counts and maxima by machine or type, which the
  metric tables merge instead of aggregating the rows again.

A batch of new rows is merged so. The parts whose key range holds a new key,
and whose filter lets one pass, are the only ones that can hold an older row
of a new key; with the parts that the new rows belong to they are read, joined by
the new rows, cut to the last row of each key by the arrival order that full
staging uses (kept in the staged files), and written as new folders. One
commit replaces these parts; all others keep their folders, unread. The
answer is the one of staging the whole history again.

New raw files are found by a file stream with a checkpoint. A batch whose
commit was made before the stream could note it is known by its number and
skipped when the stream runs it again.

Limits: a raw batch that is run again and no longer holds a key it held when
it was staged leaves that key staged, until ``rebuild`` stages everything anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.operators import bloom
from forgeline.operators import partials as P
from forgeline.operators import staging as ST
from forgeline.schemas import RAW_MAINTENANCE, RAW_PRODUCTION, RAW_TELEMETRY
from forgeline.sinks.versions import Commit, VersionedTable

PART = "staged_part"
NO_PART = "none"
STREAMED = "epoch"

_INTS = [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day", "hour")]
_ORDER = [T.StructField("_batch_id", T.StringType()), T.StructField("_src_mtime", T.LongType()), T.StructField("_src_file", T.StringType()),
          T.StructField("_src_offset", T.LongType()), T.StructField("_row_seq", T.LongType())]


def _nulls(*cols: str) -> dict[str, Column]:
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c in cols}


@dataclass(frozen=True)
class Staged:
    """How one raw table is staged. ``partials``: name to a function of rows
    with a part column giving one row for each part and key."""

    name: str
    raw: T.StructType
    time_columns: int
    key: str | None
    prepare: Callable[[DataFrame], DataFrame]
    columns: list[str]
    part: list[str]
    profile: Callable[[], dict[str, Column]]
    partials: dict[str, Callable[[DataFrame, str], DataFrame]] = field(default_factory=dict)

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([*self.raw.fields, *_ORDER, *_INTS[:self.time_columns]])

    def order_columns(self) -> list[str]:
        return [f.name for f in (*_INTS[:self.time_columns], *_ORDER)]


SPECS = {
    "telemetry": Staged(
        "telemetry", RAW_TELEMETRY, 4, "event_id", ST.prepare_telemetry, ST.TELEMETRY_COLUMNS, ["year", "month", "day"],
        lambda: {"rows": F.count(F.lit(1)), **_nulls("event_id", "machine_id", "timestamp")},
        {"health": P.health_partials, "latest": P.latest_partials}),
    "maintenance_logs": Staged(
        "maintenance_logs", RAW_MAINTENANCE, 2, "maintenance_id", ST.prepare_maintenance, ST.MAINTENANCE_COLUMNS, ["year", "month"],
        lambda: {"rows": F.count(F.lit(1)), **_nulls("maintenance_id", "machine_id", "timestamp", "maintenance_type")},
        {"downtime": P.downtime_partials, "effectiveness": P.effectiveness_partials}),
    "production": Staged(
        "production", RAW_PRODUCTION, 2, None, ST.prepare_production, ST.PRODUCTION_COLUMNS, ["year", "month", "_batch_id"],
        lambda: {"rows": F.count(F.lit(1)), **_nulls("date", "machine_id"), "neg_units": F.count_if(F.col("units_produced") < 0),
                 "neg_scrap": F.count_if(F.col("scrap_units") < 0)},
        {"scrap": P.scrap_partials}),
}


# -- one batch ---------------------------------------------------------------------

def _parted(new: DataFrame, spec: Staged, epoch: int) -> DataFrame:
    """The batch cleaned, with its part: its day or month. A batch partition
    of a table without a key is a part (a new write of it replaces the old one); rows that
    name no batch are a part of this run."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit(f"{STREAMED}-{epoch}" if c == "_batch_id" else NO_PART)) for c in spec.part]
    rows = spec.prepare(new).select(*spec.columns, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.raw_schema
                                                    if f.name in spec.order_columns()])
    return rows.withColumn(PART, F.concat_ws("-", *cols))


def possible_parts(keys: DataFrame, table: VersionedTable, now: Commit, key: str) -> list[str]:
    """Parts of the version that may hold one of the keys: the key is in the
    part's range, and its filter lets it pass. What is collected is a list of parts."""
    spark = keys.sparkSession
    ranges = [(name, p["blocks"], p["low"], p["high"]) for name, p in now.parts.items() if p.get("index")]
    if not ranges:
        return []
    distinct = keys.select(key).distinct()
    text = F.coalesce(F.col(key), F.lit("\x00"))
    low, high = distinct.agg(F.min(text), F.max(text)).first()
    if low is None:
        return []
    ranges = [r for r in ranges if r[2] <= high and low <= r[3]]
    if not ranges:
        return []
    # each key with the parts whose range holds it: the list of ranges is one entry for each day
    listed = F.array(*[F.struct(F.lit(n).alias(PART), F.lit(b).cast("long").alias("blocks"), F.lit(lo).alias("low"), F.lit(hi).alias("high"))
                       for n, b, lo, hi in ranges])
    holds = F.filter(listed, lambda r: (r["low"] <= text) & (text <= r["high"]))
    asked = distinct.select(key, F.explode(holds).alias("r")).select(key, f"r.{PART}", "r.blocks")
    folders = [table.full(now.parts[n]["index"]) for n, *_ in ranges]
    filters = spark.read.schema(f"{PART} string, block long, words array<long>").parquet(*folders)
    hit = bloom.maybe_in(asked, filters, PART, key, "blocks").select(PART).distinct()
    return [r[0] for r in hit.collect()]


def folder_of(spark: SparkSession, top: str, part: str) -> str:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{top}/{PART}={escape(part)}"


def merged_rows(table: VersionedTable, spec: Staged, new: DataFrame, now: Commit | None, touched: list[str]) -> DataFrame:
    """The touched parts with the batch in them; reads no other part."""
    if spec.key is None or now is None:
        rows = new
    else:
        old = table.read(touched, every_column=True, version=now) if touched else None
        rows = new if old is None else new.unionByName(
            old.withColumn(PART, F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit(NO_PART)) for c in spec.part])))
    return rows if spec.key is None else ST.keep_last(rows, spec.key, spec.order_columns())


def upsert(table: VersionedTable, spec: Staged, batch: DataFrame, epoch: int) -> Commit | None:
    """Merge a batch of raw rows and commit it as run ``epoch``."""
    spark = batch.sparkSession
    now = table.current()
    if now is not None and now.meta.get("epoch", -1) >= epoch:
        return None  # committed before the stream could note it
    new = _parted(batch, spec, epoch)
    own = [r[0] for r in new.select(PART).distinct().collect()]  # days, months or batches
    if not own:
        return None
    old = dict(now.parts) if now else {}
    touched = sorted({*own, *(possible_parts(new, table, now, spec.key) if spec.key and now else [])})
    in_old = [p for p in touched if p in old]
    folder = table.new_folder("rows")
    rows = merged_rows(table, spec, new, now, in_old)
    # by part, large ones over many tasks and small ones together: files of a good size whatever the skew
    rows.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(table.full(folder))

    written = spark.read.schema(T.StructType([*rows.drop(PART).schema.fields, T.StructField(PART, T.StringType())])).parquet(table.full(folder))
    stats = {k: c.alias(k) for k, c in spec.profile().items()}
    if spec.key:
        text = F.coalesce(F.col(spec.key), F.lit("\x00"))
        stats |= {"low": F.min(text).alias("low"), "high": F.max(text).alias("high")}
    found = {r[PART]: r.asDict() for r in written.groupBy(PART).agg(*stats.values()).collect()}  # one row a part
    parts = {p: v for p, v in old.items() if p not in touched}
    index = table.new_folder("index") if spec.key else None
    if index:
        sized = spark.createDataFrame([(p, bloom.blocks_for(r["rows"])) for p, r in found.items()], f"{PART} string, blocks long")
        keyed = written.select(PART, spec.key).join(F.broadcast(sized), PART)  # a row for each touched part
        filters = bloom.build(keyed, PART, spec.key, "blocks")
        filters.withColumn("dir", F.col(PART)).write.partitionBy("dir").parquet(table.full(index))
    sides = {}
    for side, of in spec.partials.items():
        sides[side] = table.new_folder(side)
        of(written, PART).withColumn("dir", F.col(PART)).write.partitionBy("dir").parquet(table.full(sides[side]))
    for p, r in found.items():
        entry = {"folder": folder_of(spark, folder, p), "profile": {k: r[k] for k in spec.profile()}}
        dir_of = folder_of(spark, "", p)[1:].replace(f"{PART}=", "dir=", 1)
        if index:
            entry |= {"index": f"{index}/{dir_of}", "blocks": bloom.blocks_for(r["rows"]), "low": r["low"], "high": r["high"]}
        entry["sides"] = {side: f"{top}/{dir_of}" for side, top in sides.items()}
        parts[p] = entry
    meta = {"epoch": epoch, "columns": spec.columns, "schema": rows.drop(PART).schema.jsonValue(), "touched": touched}
    return table.commit(parts, meta, now)


# -- runs --------------------------------------------------------------------------

def stage_new_files(spark: SparkSession, raw_path: str, table_path: str, checkpoint: str, spec: Staged) -> int:
    """Merge the raw files that no run has taken yet; returns the staged rows."""
    table = VersionedTable(spark, table_path)

    def take(batch: DataFrame, epoch: int) -> None:
        upsert(table, spec, batch, epoch)

    source = spark.readStream.schema(spec.raw_schema).option("pathGlobFilter", "*.parquet").parquet(raw_path)
    source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return staged_rows(table)


def staged_rows(table: VersionedTable) -> int:
    now = table.current()
    return sum(p["profile"]["rows"] for p in now.parts.values()) if now else 0


def rebuild(spark: SparkSession, raw_path: str, table_path: str, spec: Staged, compacted: DataFrame | None = None) -> Commit:
    """Stage the whole raw history anew as one version; ``compacted`` holds the raw rows that were moved."""
    table = VersionedTable(spark, table_path)
    before = table.current()
    empty = table.commit({}, {**(before.meta if before else {}), "epoch": -1}, before)
    raw = spark.read.schema(spec.raw_schema).option("pathGlobFilter", "*.parquet").parquet(raw_path)
    if compacted is not None:
        raw = raw.unionByName(compacted)
    epoch = before.meta.get("epoch", 0) if before else 0
    return upsert(table, spec, raw, epoch) or empty


# -- what the parts know --------------------------------------------------------------

def table_profile(table: VersionedTable) -> DataFrame | None:
    """One row of the table's counts, added up over its parts; no rows are read."""
    now = table.current()
    if now is None or not all("profile" in p for p in now.parts.values()):
        return None
    names = sorted({k for p in now.parts.values() for k in p["profile"]})
    if not names:
        return None
    total = tuple(sum(p["profile"][k] for p in now.parts.values()) for k in names)
    return table.spark.createDataFrame([total], ", ".join(f"{n} long" for n in names))


def side_table(table: VersionedTable, side: str) -> DataFrame | None:
    """The partial metrics of all parts."""
    now = table.current()
    if now is None or not all(side in p.get("sides", {}) for p in now.parts.values()) or not now.parts:
        return None
    return table.spark.read.parquet(*[table.full(p["sides"][side]) for p in now.parts.values()])
