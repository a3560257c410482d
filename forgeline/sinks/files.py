"""Lake writers.

* raw tables are appended, partitioned by time and by ingest batch; a retried
  batch replaces only its own partitions (dynamic partition overwrite), so a
  retry never duplicates and never touches other batches;
* staging / analytics tables are versioned (``sinks.versions``);
* reports are small, bounded tables rewritten as JSON;
* logs (run history, lineage) are appended one small file per record, with
  no read-modify-write.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgeline.sinks.versions import VersionedTable

DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def write_batch_partitions(df: DataFrame, path: str, partition_cols: list[str],
                           max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE, metrics: list[Column] | None = None) -> dict:
    """Write one ingest batch below ``path``. ``partition_cols`` must end with
    the batch column, so the dynamic overwrite replaces only this batch.
    Returns the ``metrics`` (named aggregates) that the write itself observed; none for a batch without rows.

    The rows are rebalanced by partition value first: the many small shares of
    an hour come together in one file, while an hour that holds much of the batch is
    split over several tasks, each writing files of ``max_records_per_file`` at
    most. A batch so has a few files for each partition it touches, not one for each task."""
    out, seen = df.hint("rebalance", *[F.col(c) for c in partition_cols]), Observation()
    if metrics:
        out = out.observe(seen, *metrics)
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_cols)
        .parquet(path))
    if not metrics:
        return {}
    try:
        return seen.get
    except Py4JJavaError as exc:
        if "AssertionError" not in str(exc.java_exception):
            raise
        return {}  # adaptive execution drops an empty plan, and what observes it


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table as a whole: the new version is committed once it is
    complete, so a write that stops leaves the old one readable."""
    VersionedTable(df.sparkSession, path).replace(df)


def write_report(df: DataFrame, path: str) -> None:
    """A bounded report (a handful of rows) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").json(path)


def drop_stale_partitions(spark: SparkSession, path: str, partition_cols: list[str], batch_id: str, places: list[str]) -> list[str]:
    """Remove the partitions of a batch that its last write did not make.
    ``places`` are those it made (values of the columns before the batch column, joined by slashes)."""
    jvm = spark.sparkContext._jvm
    of_batch = jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{c}=*" for c in partition_cols[:-1])]))
    fs = of_batch.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    name = f"{partition_cols[-1]}={jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)}"
    made = {"/".join(f"{c}={v}" for c, v in zip(partition_cols, place.split("/"))) for place in places}
    gone = []
    for status in fs.globStatus(of_batch) or []:
        place = "/".join(str(status.getPath()).split("/")[1 - len(partition_cols):])
        folder = jvm.org.apache.hadoop.fs.Path(status.getPath(), name)
        if place not in made and fs.exists(folder):
            fs.delete(folder, True)
            gone.append(place)
    return gone
