"""Cutting lineage with a written table.

A DataFrame is written once as Parquet below the cluster's reliable
checkpoint folder (``spark.checkpoint.dir``) and read back. Unlike
``DataFrame.checkpoint()`` the rows are computed once (an RDD checkpoint
computes them for the action and again for the checkpoint write), and the
read-back is columnar, so later plans prune columns and push filters into
it. The written files survive lost executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from forgeline.session import ensure_checkpoint_dir


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/forgeline-tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row DataFrames with distinct columns into one row.

    The frames are united by name (other frames' columns null) and reduced
    by one global aggregate. Unlike scalar subqueries, which the optimizer
    re-optimizes on every pass, this stays one small plan; unlike a cross
    join it cannot multiply rows.
    """
    from functools import reduce

    from pyspark.sql import functions as F

    cols = [c for f in frames for c in f.columns]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.agg(*[F.max(c).alias(c) for c in cols])
