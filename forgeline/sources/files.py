"""Lake and source-file readers.

Schemas are declared, never inferred. Columns are taken by name: a column
missing from a file is null, an unknown one is dropped. Parse errors fail
the read (FAILFAST / ANSI casts), as the reference's ingest does.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.schemas import SCAN_ORDER_COLUMNS
from forgeline.sinks.versions import VersionedTable
from forgeline.sources.csv_splits import read_csv_records


def _absent(exc: AnalysisException) -> bool:
    text = str(exc)
    return any(tag in text for tag in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "Path does not exist"))


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | None = None, **options) -> DataFrame | None:
    """A table, or None when nothing is stored at ``path`` yet. Of a
    versioned table the newest version."""
    if fmt == "parquet" and schema is None:
        table = VersionedTable(spark, path)
        if table.exists():
            return table.read()
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
        if schema is not None:
            # a schema-given read of an absent path is lazy; probe the listing
            df.inputFiles()
        return df
    except AnalysisException as exc:
        if _absent(exc):
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """Every ``*.parquet`` file below ``path``, all partitions, united by
    column name (a column missing in older files is null)."""
    return read_or_none(spark, path, "parquet", mergeSchema="true", pathGlobFilter="*.parquet")


def by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to their declared type; missing
    columns are null, other columns are dropped (scan-order columns kept)."""
    present = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in SCAN_ORDER_COLUMNS if c in present]
    return df.select(*cols, *extra)


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType,
                     source_order: bool = True) -> DataFrame | None:
    """CSV with a header row; every field read as text, then cast by the
    declared type (a bad number raises under ANSI). An unquoted empty field
    is null. A quoted field may hold doubled quotes and line ends; a file is still
    read by many tasks (``sources.csv_splits``). A folder in which a file's header differs from the
    others' is refused, since its columns would be read in the wrong order.
    With ``source_order`` the scan-order columns are added."""
    if read_or_none(spark, path, "text") is None:
        return None
    raw = read_csv_records(spark, path)
    return by_name(raw if source_order else raw.drop(*SCAN_ORDER_COLUMNS), schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               source_order: bool = True) -> DataFrame | None:
    """JSON lines; blank lines are skipped, unknown keys dropped."""
    raw = read_or_none(spark, path, "json", schema=schema, mode="FAILFAST")
    if raw is None:
        return None
    return with_source_order(raw) if source_order else raw


def read_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Whole-file JSON documents (state, reports): one record per file or a
    top-level array of records; absent -> None."""
    return read_or_none(spark, path, "json", schema=schema, multiLine="true", mode="FAILFAST")


def read_jdbc_by_name(spark: SparkSession, url: str, table: str, schema: T.StructType,
                      properties: dict | None = None, partition_column: str | None = None,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """A relational source table (the maintenance data the reference's
    documents describe as coming from Postgres), typed by name like the CSV
    sources. With ``partition_column`` and bounds the read is split into
    ``num_partitions`` parallel range queries instead of one connection.

    Not exercised by the tests: it needs a database server, and none may be
    started in this environment.
    """
    options = dict(properties or {})
    if partition_column is not None:
        options.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                       upperBound=str(upper_bound), numPartitions=str(num_partitions or 1))
    raw = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
    return by_name(raw, schema)


def with_source_order(df: DataFrame) -> DataFrame:
    """Scan-order columns of a file read: when the file arrived, source file, split offset and row
    position inside the split (increasing in file order within a split)."""
    return df.select(
        "*",
        F.unix_micros("_metadata.file_modification_time").alias("_src_mtime"),
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_offset"),
        F.monotonically_increasing_id().alias("_row_seq"),
    )
