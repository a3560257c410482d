"""Exact dedup over an extendible-hash index on shared files.

1. One scan writes a small row for each document: its 64-bit hash key and
   its digest. No text is shuffled here.
2. The directory: a bucket holds the keys that share its leading bits. While
   a bucket has more keys than its capacity it is split by one more bit; when
   the split bucket is as deep as the directory, the directory doubles. Only
   counts by prefix reach the driver, never keys.
3. Texts of equal key meet in one hash aggregate on (key, text), which
   compares the bytes of the texts and collapses copies before the shuffle,
   so a hot group of copies moves as one row for each task.
4. The distinct texts go to the owner task of their bucket. It chains those
   whose keys collide and writes the bucket to the index (a Parquet folder,
   partitioned by bucket, in ``spark.checkpoint.dir``).
5. The rows of step 1 look up their chain entry: the directory gives the
   bucket of a row's slot, and the entry is sought in that bucket alone.

Only DataFrame functions run; there is no Python in the plan.

Defined cases: a null text counts as empty; all empty texts are equal. Null
``doc_id``: ignored by "largest", stays only if the group has no other. Rows
repeated with the same ``doc_id`` and text: each gives a row, one of them is
kept. Texts are equal only if all their bytes are. An empty table gives an
empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.llm.shared import text_or_empty, write_shared

PROBE_BITS = 12


def hash_key(text: Column, bits: int = 64) -> Column:
    """Leading ``bits`` of the text's XXH64 (fewer only to force collisions in tests)."""
    h = F.xxhash64(text)
    return h if bits >= 64 else h.bitwiseAND(F.lit(-(1 << (64 - bits))))


def slot_of(key: Column, depth: int) -> Column:
    """The key's leading ``depth`` bits."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def split_buckets(counts: dict[int, int], bits: int, capacity: int) -> list[tuple[int, int, int]]:
    """Buckets as (depth, prefix, keys): from one bucket over all ``counts``
    (keys by ``bits``-bit prefix), each overfull one is split by its next
    bit until it fits or the prefixes end."""
    out, todo = [], [(0, 0, dict(counts))]
    while todo:
        depth, prefix, own = todo.pop()
        total = sum(own.values())
        if total <= capacity or depth == bits:
            out.append((depth, prefix, total))
            continue
        for bit in (0, 1):
            half = {p: n for p, n in own.items() if (p >> (bits - depth - 1)) & 1 == bit}
            todo.append((depth + 1, prefix * 2 + bit, half))
    return sorted(out, key=lambda b: b[1] << (bits - b[0]))


def build_directory(entries: DataFrame, bucket_keys: int, max_buckets: int) -> tuple[int, list[int]]:
    """(depth, first slot of the bucket of each slot). ``max_buckets`` bounds
    the directory: with more data the capacity grows instead."""
    found = entries.groupBy(slot_of(F.col("key"), PROBE_BITS).alias("p")).agg(F.count_distinct("key").alias("n"))
    counts = {r["p"]: r["n"] for r in found.collect()}  # at most 2**PROBE_BITS rows
    capacity, bits = max(bucket_keys, -(-sum(counts.values()) // max_buckets)), PROBE_BITS
    buckets = split_buckets(counts, bits, capacity)
    if any(n > capacity for _, _, n in buckets):
        # deeper counts, as many as the directory may have slots; a bucket
        # that is overfull beyond them keeps its keys and chains them
        bits = max(PROBE_BITS, max_buckets.bit_length())
        found = entries.groupBy(slot_of(F.col("key"), bits).alias("p")).agg(F.count_distinct("key").alias("n"))
        buckets = split_buckets({r["p"]: r["n"] for r in found.collect()}, bits, capacity)
    depth = max(d for d, _, _ in buckets)
    slots = []
    for d, prefix, _ in buckets:
        slots += [prefix << (depth - d)] * (1 << (depth - d))
    return depth, slots


def directory_table(spark: SparkSession, depth: int, slots: list[int]) -> DataFrame:
    """(slot, depth, bucket): the bucket of each slot of the directory."""
    return spark.createDataFrame([(i, depth, b) for i, b in enumerate(slots)], "slot long, depth int, bucket long")


def with_bucket(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows with the bucket that the directory gives for their key."""
    depth = directory.first()["depth"]
    return rows.withColumn("slot", slot_of(F.col("key"), depth)).join(directory.drop("depth"), "slot").drop("slot")


def look_up(rows: DataFrame, index: DataFrame, directory: DataFrame) -> DataFrame:
    """Rows (with key and sha) with group_size, keep_id and chain of their
    entry. The index is laid out by bucket; an entry is found only in the
    bucket that the directory names for the row's key."""
    return with_bucket(rows, directory).join(index.select("bucket", "key", "sha", "group_size", "keep_id", "chain"), ["bucket", "key", "sha"])


def exact_dedup(docs: DataFrame, bucket_keys: int = 8192, max_buckets: int = 65536, hash_bits: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, key (the 64-bit hash key), chain (place among colliding texts)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("key", hash_key(F.col("text"), hash_bits))
    digest = F.unhex(F.sha2("text", 256))
    entries = write_shared(texts.select("doc_id", "key", digest.alias("sha")), "dedup-entries")

    depth, slots = build_directory(entries, bucket_keys, max_buckets)
    directory = directory_table(spark, depth, slots)

    distinct = (texts.groupBy("key", "text").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
                .select("key", digest.alias("sha"), "group_size", "keep_id"))
    owned = with_bucket(distinct, directory).repartition("bucket")
    chain = Window.partitionBy("bucket", "key")
    same = F.count(F.lit(1)).over(chain.partitionBy("bucket", "key", "sha"))
    clash = F.raise_error(F.lit("two different texts have one SHA-256 digest")).cast("long")
    index = write_shared(
        owned.select("key", "sha", F.when(same == 1, F.col("group_size")).otherwise(clash).alias("group_size"), "keep_id",
                     F.row_number().over(chain.orderBy("sha")).alias("chain"), "bucket"),
        "dedup-index", ("bucket",))

    rows = entries.groupBy("key", "sha", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    found = look_up(rows, index, directory)
    each = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "key", "chain")


def keep_distinct(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stay = exact_dedup(docs, **params).where("kept").select(F.struct(F.col("doc_id").alias("i"), F.col("text_sha256").alias("s")).alias("__doc"))
    rows = docs.select(F.struct("*").alias("__row"), F.struct(F.col("doc_id").alias("i"), F.sha2(text_or_empty(), 256).alias("s")).alias("__doc"))
    # rows repeated with one doc_id and text: one stays
    return rows.join(stay, "__doc", "left_semi").dropDuplicates(["__doc"]).select("__row.*")
