"""Connected components of a link table by alternating large-star and
small-star steps. Every step is a grouped minimum and a join, written to the
shared folder; no link, component or node list reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.shared import write_shared


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Large star: each node's larger neighbours are tied to the least of the
    node and its neighbours. Small star: its smaller neighbours and itself are."""
    if small:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m"))
        tied = near.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        tied = near.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (id, component) for every node with a link to
    another one; ``component`` is the least id of its component."""
    now = write_shared(links.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        now = write_shared(_stars(now, small=False), "links")
        now = write_shared(_stars(now, small=True), "links")
    # stable: every node hangs on the least one of its component
    ids = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component"))).groupBy("id").agg(
        F.min("component").alias("component"))
