"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target number of words. Complete epochs over the source
come first; what remains of the target is drawn without replacement: every
document has an exponential key ``-ln(u) / w`` (``u`` from a hash of its id,
``w`` its quality weight), the documents are taken in ascending order of the
keys while their summed sizes stay nearest the budget.

The order within a source is never made by one task: the keys fall into
``bins`` ranges, sums by (source, range) are prefix-summed, and only the one
range in which a source's budget ends is ordered document by document.

Defined cases: a null text has size 0; null is a source of its own, after
all others; a null ``doc_id`` hashes like the text "null". Sources without
words get target 0. Documents with equal keys are ordered by ``doc_id``, then
size; repeated rows are separate documents. An empty table gives an empty
result. Extra columns are not read, whatever their names. The hash, and so
the result, is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.shared import SPACE_CLASS, WORD_CLASS, text_or_empty, write_shared

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2.0


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_CLASS + "+")).cast("long")


def quality_weight(text: Column) -> Column:
    """0.5 to 1.5: one half plus the share of letters in the text's visible characters."""
    visible = F.length(F.regexp_replace(text, SPACE_CLASS + "+", ""))
    other = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D\p{L}]+", ""))
    return F.lit(0.5) + F.when(visible > 0, (visible - other) / visible).otherwise(0.0)


def uniform(doc_id: Column) -> Column:
    """In (0, 1), from the first 52 bits of the MD5 of the id."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sums: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """``sums`` (source, source_size; a row for each source) with ``target``.

    Sharing the excess of full sources by weight, again and again, ends where
    target = least(most * size, level * weight) with one level for all: order
    the sources by most * size / weight, and take the first at which the
    level left by the full ones does not exceed it. The windows without a
    partition run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    w = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    ahead = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = ahead.rowsBetween(Window.unboundedPreceding, -1), ahead.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = w.withColumn("left_over", F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    w = w.withColumn("level", F.col("left_over") / F.sum("weight").over(after))
    w = w.withColumn("place", F.row_number().over(ahead))
    stops = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("place"))
    w = w.withColumn("first", F.min(stops).over(everything))
    w = w.withColumn("level", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything))
    target = F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap"))
    return w.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS, bins: int = 4096) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies (times the document
    is taken), sample_key; a row for each row of ``docs``."""
    text = text_or_empty()
    es = -F.log(uniform(F.col("doc_id"))) / quality_weight(text)
    rows = docs.select("doc_id", "source", word_count(text).alias("size"), es.alias("sample_key"))
    rows = rows.withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.lit(bins) * (1 - F.exp(-F.col("sample_key"))))).cast("int"))
    rows = write_shared(rows, "mix-keys")

    sums = write_shared(rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "mix-bins")
    targets = source_targets(sums.groupBy("source").agg(F.sum("bin_size").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    binned = sums.withColumn("bin_end", F.sum("bin_size").over(upto)).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), "bin_end", (F.col("bin_end") - F.col("bin_size")).alias("bin_start"))
    plan = binned.join(budget, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    found = rows.join(plan, rows["source"].eqNullSafe(plan["s"]) & (rows["bin"] == plan["b"]))

    whole = found.where("bin_end <= rest or bin_start >= rest").withColumn("extra", (F.col("bin_end") <= F.col("rest")).cast("long"))
    inner = Window.partitionBy("s", "b").orderBy("sample_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = found.where("bin_end > rest and bin_start < rest").withColumn("end", F.col("bin_start") + F.sum("size").over(inner))
    nearest = F.col("end") + F.col("end") - F.col("size") <= 2 * F.col("rest")
    split = split.withColumn("extra", nearest.cast("long")).drop("end")
    both = whole.unionByName(split).withColumn("copies", F.col("epochs") + F.col("extra"))
    return both.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "sample_key", "source")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.
    Documents without words are not taken."""
    # rows with the same id, source and size are alike to the plan: one copy number for all
    plan = mix(docs, **params).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("n"))
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "c", "n").where("c > 0 and __size > 0")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__doc"), F.col("source").alias("__from"), word_count(text_or_empty()).alias("__words"))
    same = rows["__doc"].eqNullSafe(plan["__id"]) & rows["__from"].eqNullSafe(plan["__source"]) & (rows["__words"] == plan["__size"])
    # c copies over n such rows: the first c % n of them get one more
    both = rows.join(plan, same)
    one = both.where("n = 1").select("__row", F.col("c").alias("times"))
    order = Window.partitionBy("__doc", "__from", "__words").orderBy(F.xxhash64("__row"))
    more = both.where("n > 1").withColumn("i", F.row_number().over(order)).select(
        "__row", (F.floor(F.col("c") / F.col("n")) + (F.col("i") <= F.col("c") % F.col("n")).cast("long")).alias("times"))
    taken = one.unionByName(more).where("times > 0")
    return taken.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))).select("__row.*")
