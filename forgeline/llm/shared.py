"""Small helpers of the training-data operators: written tables in the
cluster's shared folder, and the definitions of "word" and "white space"
that the contracts share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.session import ensure_checkpoint_dir

#: white space of the contracts: space and the code points 9 to 13
SPACES = " \t\n\x0b\x0c\r"
#: the same as a regular expression class
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, everything else as it is."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty array where it has none."""
    bare = F.trim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "+"))


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. The rows are
    computed once, later plans start from files that a lost executor does
    not take along, and they read only the columns they need."""
    path = shared_path(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_shared(spark: SparkSession) -> None:
    """Remove every table that this session's operators have written. To be
    called when no DataFrame that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def open_shared(uri: str):
    """(pyarrow file system, path in it) of a shared folder, for the
    operators that write files of their own format inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, as ``--py-files`` would, once
    for each session; for callers that are not deployed with it."""
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_forgeline_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="forgeline-")), "forgeline.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._forgeline_shipped = True
