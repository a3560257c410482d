"""Data-quality checks. Each returns a one-row DataFrame in the
``QualityResult`` shape (check_name, passed, severity, details,
records_checked, records_failed); ``quality_report`` unions them.

All counting is distributed; the only rows that reach a text are the first 10
missing numbers (as in the reference) and counts. Unknown ids are a table,
``unknown_machine_ids``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline import config as C
from forgeline.functions.messages import message
from forgeline.functions.text import id_number, zero_pad
from forgeline.plans.joins import lookup_join
from forgeline.plans.materialize import one_row
from forgeline.schemas import QUALITY_RESULT

CHECK_ORDER = list(C.CHECK_NAMES)


def _result(df: DataFrame, name: str, passed: Column, severity: Column, details: Column,
            checked: Column, failed: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        severity.alias("severity"),
        details.alias("details"),
        checked.cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("records_failed"),
    )


def missing_table_result(spark: SparkSession, name: str, what: str) -> DataFrame:
    return spark.createDataFrame(
        [(name, False, C.ERROR, C.MSG_NO_STAGED.format(what=what), 0, 0)], QUALITY_RESULT)


# -- missing telemetry (gaps in the event number sequence) -------------------

def event_numbers(telemetry: DataFrame) -> DataFrame:
    """Number of every non-empty event id (``evt_`` removed)."""
    ids = telemetry.where(F.col("event_id").isNotNull() & (F.col("event_id") != ""))
    return ids.select(id_number("event_id", "evt_").alias("n"))


BUCKET_BITS = 15  # numbers of a bitmap of bitmap_construct_agg
SUPER_BITS = 15  # buckets that one window looks at


def number_buckets(telemetry: DataFrame) -> DataFrame:
    """The event numbers as bitmaps: one row for each run of 32,768 numbers
    that has some (bucket, bits, c: ids, d: different numbers, lo, hi). One grouped
    aggregate, combined in the map tasks: all else works on these rows."""
    n = F.col("n")
    buckets = event_numbers(telemetry).groupBy(F.shiftright(n, BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(n.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("bits"),
        F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return buckets.withColumn("d", F.bitmap_count("bits"))


def _missing_inside() -> Column:
    """The numbers between ``lo`` and ``hi`` of a bucket that its bits do not
    have, ascending. Full bytes are passed over, full buckets as a whole."""
    base = "(bucket * 32768L)"
    of_byte = "filter(sequence(i * 8, i * 8 + 7), p -> getbit(cast(ascii(ch) AS bigint), p - i * 8) = 0)"
    bytes_ = "split(decode(bits, 'ISO-8859-1'), '')"
    unset = f"flatten(transform({bytes_}, (ch, i) -> if(ch = '\u00ff', cast(array() AS array<int>), {of_byte})))"
    numbers = f"filter(transform({unset}, p -> {base} + p), n -> n > lo AND n < hi)"
    return F.expr(f"if(d = hi - lo + 1, cast(array() AS array<bigint>), {numbers})")


def _edge_gaps(buckets: DataFrame) -> DataFrame:
    """(gap_start, gap_end) between neighbouring buckets: windows over runs of
    32,768 buckets, then one over the runs, one row for each 2**30 numbers."""
    runs = buckets.select(F.shiftright("bucket", SUPER_BITS).alias("run"), "bucket", "lo", "hi")
    inside = runs.withColumn("after", F.lead("lo").over(Window.partitionBy("run").orderBy("bucket")))
    between = runs.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")) \
        .withColumn("after", F.lead("lo").over(Window.orderBy("run")))
    edges = inside.select("hi", "after").unionByName(between.select("hi", "after"))
    return edges.where(F.col("after") > F.col("hi") + 1).select((F.col("hi") + 1).alias("gap_start"), (F.col("after") - 1).alias("gap_end"))


def missing_event_sample(telemetry: DataFrame, first: int = C.TOP_N,
                         buckets: DataFrame | None = None) -> DataFrame:
    """The ``first`` smallest missing event numbers (one row each): the first
    ones of each bucket and of each gap between buckets, of which the least are kept."""
    buckets = number_buckets(telemetry) if buckets is None else buckets
    inside = buckets.select(F.explode(F.slice(_missing_inside(), 1, first)).alias("n"))
    edges = _edge_gaps(buckets).select(F.explode(F.sequence(
        "gap_start", F.least("gap_end", F.col("gap_start") + (first - 1)))).alias("n"))
    return inside.unionByName(edges).orderBy("n").limit(first)


def missing_event_ranges(telemetry: DataFrame) -> DataFrame:
    """Every gap of the event number sequence as ``(gap_start, gap_end,
    missing)``: runs of unset bits inside the buckets, joined at their edges by
    the gaps between buckets (a gap that ends with a bucket is none of its inside)."""
    buckets = number_buckets(telemetry)
    inside = buckets.select("bucket", F.explode(_missing_inside()).alias("n"))
    # neighbours in a bucket keep their distance to their rank
    w = Window.partitionBy("bucket").orderBy("n")
    islands = inside.withColumn("island", F.col("n") - F.row_number().over(w)).groupBy("bucket", "island").agg(
        F.min("n").alias("gap_start"), F.max("n").alias("gap_end"))
    gaps = islands.select("gap_start", "gap_end").unionByName(_edge_gaps(buckets))
    return gaps.withColumn("missing", F.col("gap_end") - F.col("gap_start") + 1)


def check_missing_telemetry(telemetry: DataFrame, sample_size: int = C.TOP_N) -> DataFrame:
    """Gaps in the event number sequence; the text names the first and the
    last of the ``sample_size`` first missing numbers."""
    buckets = number_buckets(telemetry)
    stats = buckets.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("cnt"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("distinct_n"),
    )
    sample = missing_event_sample(telemetry, first=sample_size, buckets=buckets)
    stats = one_row(stats, sample.agg(F.min("n").alias("sample_lo"), F.max("n").alias("sample_hi")))
    sample_lo, sample_hi = F.col("sample_lo"), F.col("sample_hi")
    span = F.col("hi") - F.col("lo") + 1
    missing = span - F.col("distinct_n")
    too_few = F.col("cnt") < 2
    gaps = missing > 0
    details = (
        F.when(too_few, F.lit(C.MSG_TOO_FEW_EVENTS))
        .when(gaps, message(C.MSG_GAPS, missing=missing, first=zero_pad(sample_lo, 6),
                            last=zero_pad(sample_hi, 6)))
        .otherwise(F.lit(C.MSG_NO_GAPS))
    )
    return _result(
        stats, C.CHECK_NAMES[0],
        passed=too_few | ~gaps,
        severity=F.when(~too_few & gaps, F.lit(C.WARNING)).otherwise(F.lit(C.INFO)),
        details=details,
        checked=F.when(too_few, F.col("cnt")).when(gaps, span).otherwise(F.col("distinct_n")),
        failed=F.when(~too_few & gaps, missing).otherwise(F.lit(0)),
    )


# -- negative production -----------------------------------------------------

def production_profile(production: DataFrame) -> DataFrame:
    """One scan of production for both the negative-value and the null
    checks: rows, nulls of the critical fields (``n0``, ``n1``) and negative
    cells. Used by both checks, the aggregate's exchange is shared."""
    fields = CRITICAL_FIELDS["production"]
    return production.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(fields)],
        F.count_if(F.col("units_produced") < 0).alias("neg_units"),
        F.count_if(F.col("scrap_units") < 0).alias("neg_scrap"),
    )


def check_negative_production(production: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    stats = profile if profile is not None else production.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("units_produced") < 0).alias("neg_units"),
        F.count_if(F.col("scrap_units") < 0).alias("neg_scrap"),
    )
    total = F.col("neg_units") + F.col("neg_scrap")
    return _result(
        stats, C.CHECK_NAMES[1],
        passed=total == 0,
        severity=F.when(total > 0, F.lit(C.ERROR)).otherwise(F.lit(C.INFO)),
        details=F.when(total > 0, message(C.MSG_NEGATIVES, units=F.col("neg_units"), scrap=F.col("neg_scrap")))
        .otherwise(F.lit(C.MSG_NO_NEGATIVES)),
        checked=F.col("rows"),
        failed=total,
    )


# -- machine id mismatches ---------------------------------------------------

def unknown_machine_ids(machines: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Distinct machine ids of each source that are not in the dimension
    (``source``, ``machine_id``); a null id is unknown unless the dimension
    has one too."""
    dim = machines.select("machine_id").distinct()
    parts = []
    for name, df in sources.items():
        ids = df.select("machine_id").distinct()
        unknown = lookup_join(ids, dim, "machine_id", how="left_anti", null_safe=True, bound_by=machines)
        parts.append(unknown.select(F.lit(name).alias("source"), "machine_id"))
    return reduce(DataFrame.unionByName, parts)


def check_machine_id_mismatches(machines: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Details name the number of unknown ids of each source; the ids
    themselves are the table ``unknown_machine_ids``, which has no bound."""
    unknown = unknown_machine_ids(machines, sources)
    order = {name: i for i, name in enumerate(sources)}
    order_col = F.element_at(F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))]),
                             F.col("source"))
    counts = unknown.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    entries = counts.select(order_col.alias("o"), F.concat("source", F.lit(": "), F.col("n").cast("string")).alias("entry"), "n")
    summary = entries.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "entry"))),
                                 lambda s: s["entry"]), "; ").alias("text"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("bad"),
    )
    valid = machines.agg(
        (F.count_distinct("machine_id") + F.max(F.col("machine_id").isNull().cast("int"))).alias("valid"))
    combined = one_row(valid, summary)
    bad, text = F.coalesce(F.col("bad"), F.lit(0)), F.col("text")
    return _result(
        combined, C.CHECK_NAMES[2],
        passed=bad == 0,
        severity=F.when(bad > 0, F.lit(C.WARNING)).otherwise(F.lit(C.INFO)),
        details=F.when(bad > 0, message(C.MSG_UNKNOWN_IDS, entries=text))
        .otherwise(F.lit(C.MSG_IDS_MATCH)),
        checked=F.coalesce(F.col("valid"), F.lit(0)),
        failed=bad,
    )


# -- nulls in critical fields --------------------------------------------------

CRITICAL_FIELDS = {
    "telemetry": ["event_id", "machine_id", "timestamp"],
    "production": ["date", "machine_id"],
    "maintenance_logs": ["maintenance_id", "machine_id"],
}


def null_counts(tables: dict[str, DataFrame], fields: dict[str, list[str]] | None = None,
                profiles: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, column_name, position, rows, nulls): one scan per table,
    or a given profile aggregate with columns ``rows``, ``n0``, ``n1``, ..."""
    fields = CRITICAL_FIELDS if fields is None else fields
    profiles = profiles or {}
    parts = []
    pos = 0
    for name, cols in fields.items():
        df = tables.get(name)
        if df is None:
            continue
        agg = profiles.get(name)
        if agg is None:
            agg = df.agg(F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
        stacked = agg.select(
            "rows",
            F.explode(F.array(*[
                F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                         F.lit(pos + i).alias("position"), F.col(f"n{i}").alias("nulls"))
                for i, c in enumerate(cols)])).alias("s"))
        parts.append(stacked.select("s.table_name", "s.column_name", "s.position", "rows", "s.nulls"))
        pos += len(cols)
    return reduce(DataFrame.unionByName, parts)


def check_null_critical_fields(tables: dict[str, DataFrame],
                               fields: dict[str, list[str]] | None = None,
                               profiles: dict[str, DataFrame] | None = None) -> DataFrame:
    counts = null_counts(tables, fields, profiles)
    entry = F.when(F.col("nulls") > 0, F.struct(
        "position", F.concat("table_name", F.lit(":"), "column_name", F.lit("="),
                             F.col("nulls").cast("string")).alias("e")))
    stats = counts.agg(
        F.sum("rows").alias("checked"),
        F.sum("nulls").alias("nulls"),
        F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda s: s["e"]), ", ").alias("text"),
    )
    nulls = F.coalesce(F.col("nulls"), F.lit(0))
    return _result(
        stats, C.CHECK_NAMES[3],
        passed=nulls == 0,
        severity=F.when(nulls > 0, F.lit(C.ERROR)).otherwise(F.lit(C.INFO)),
        details=F.when(nulls > 0, message(C.MSG_NULLS, entries=F.col("text")))
        .otherwise(F.lit(C.MSG_NO_NULLS)),
        checked=F.coalesce(F.col("checked"), F.lit(0)),
        failed=nulls,
    )


# -- report --------------------------------------------------------------------

def quality_report(telemetry: DataFrame | None, production: DataFrame | None,
                   maintenance: DataFrame | None, machines: DataFrame | None,
                   spark: SparkSession | None = None, profiles: dict[str, DataFrame] | None = None) -> DataFrame:
    """All four checks in the reference's order, with ``check_order``.
    An absent staged table gives the failed/error row of the reference.
    ``profiles`` holds one row of counts for tables that know them (columns
    ``rows``, ``n0``, ``n1``, ..., of production also ``neg_units`` and
    ``neg_scrap``); the null and negative checks then read no row of the table."""
    spark = spark or next(df for df in (telemetry, production, maintenance, machines)
                          if df is not None).sparkSession
    profiles = dict(profiles or {})
    if production is not None and "production" not in profiles:
        profiles["production"] = production_profile(production)
    rows = [
        check_missing_telemetry(telemetry) if telemetry is not None
        else missing_table_result(spark, C.CHECK_NAMES[0], "telemetry"),
        check_negative_production(production, profiles.get("production")) if production is not None
        else missing_table_result(spark, C.CHECK_NAMES[1], "production"),
    ]
    sources = {k: v for k, v in (("telemetry", telemetry), ("production", production),
                                 ("maintenance_logs", maintenance)) if v is not None}
    if machines is None:
        rows.append(missing_table_result(spark, C.CHECK_NAMES[2], "machines"))
    elif sources:
        rows.append(check_machine_id_mismatches(machines, sources))
    else:
        rows.append(check_machine_id_mismatches(machines, {"machines": machines.limit(0)}))
    tables = {"telemetry": telemetry, "production": production, "maintenance_logs": maintenance}
    if any(v is not None for v in tables.values()):
        rows.append(check_null_critical_fields(tables, profiles=profiles))
    else:
        rows.append(spark.createDataFrame(
            [(C.CHECK_NAMES[3], True, C.INFO, C.MSG_NO_NULLS, 0, 0)], QUALITY_RESULT))
    report = reduce(DataFrame.unionByName, rows)
    order = F.create_map(*[x for i, n in enumerate(CHECK_ORDER) for x in (F.lit(n), F.lit(i))])
    return report.withColumn("check_order", F.element_at(order, F.col("check_name")))


def quality_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def first_blocking_failure(report: DataFrame) -> DataFrame:
    """The first failed check of severity error, in check order (for
    fail-early runs); empty when none."""
    return report.where(~F.col("passed") & (F.col("severity") == C.ERROR)) \
        .orderBy("check_order").limit(1)
