"""Blocked Bloom filters as DataFrames, built and probed by expressions.

A filter is a set of blocks of ``BITS`` bits. A key's first hash names its
block, a second one gives the ``PROBES`` bits in it, so that a probe is an
equi-join on the block and a few bit tests. Filters are built for every group
of a table at once by grouped ORs, which combine in the map tasks; no filter
is collected or broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, WORDS = 1024, 16
PROBES = 6
#: about ten bits a key: one key in a hundred that is not there passes
KEYS_PER_BLOCK = 100


def blocks_for(keys: int) -> int:
    return max(1, -(-keys // KEYS_PER_BLOCK))


def _text(key: str) -> Column:
    """A null key is a key like others."""
    return F.coalesce(F.col(key).cast("string"), F.lit("\x00"))


def block_of(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(_text(key)), blocks)


def _places(key: str) -> list[Column]:
    second = F.xxhash64(_text(key), F.lit(1))
    return [F.shiftrightunsigned(second, 10 * i).bitwiseAND(F.lit(BITS - 1)).cast("int") for i in range(PROBES)]


def build(keys: DataFrame, group: str, key: str, blocks: str) -> DataFrame:
    """(group, block, words) of the filter of each group; the column ``blocks`` holds
    how many blocks its group's filter has."""
    bits = keys.select(group, block_of(key, F.col(blocks)).alias("block"), F.explode(F.array(*_places(key))).alias("place"))
    words = bits.groupBy(group, "block", F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("bits"))
    packed = words.groupBy(group, "block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    return packed.select(group, "block", F.expr(f"transform(sequence(0, {WORDS - 1}), i -> coalesce(m[i], 0L))").alias("words"))


def passes(key: str, words: str = "words") -> Column:
    """Whether the key may be in the filter block ``words``."""
    test = F.lit(True)
    for p in _places(key):
        test = test & (F.getbit(F.get(words, F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1)
    return test


def maybe_in(keys: DataFrame, filters: DataFrame, group: str, key: str, blocks: str) -> DataFrame:
    """Rows of ``keys`` (with a group to test and that group's ``blocks``) that
    may be in the group's filter."""
    tested = keys.withColumn("block", block_of(key, F.col(blocks)))
    return tested.join(filters, [group, "block"]).where(passes(key)).drop("block", "words")


#: blocks of a filter that is sent to every task: 8 MB at most, however many keys it is given
SENT_BLOCKS = 1 << 16


def rows_of(rows: DataFrame, keys: DataFrame, key: str, blocks: int = SENT_BLOCKS) -> DataFrame:
    """The rows whose non-null ``key`` is among ``keys`` (different ones, in one
    column of that name). Rows meet a filter of the keys where they are read, and
    only those that pass are shuffled to the exact join. The filter has a fixed number of
    blocks, so its size has a bound; more keys than it is good for let more rows pass."""
    whole = keys.select(F.lit(0).alias("__of"), key, F.lit(blocks).cast("long").alias("__n"))
    sent = build(whole, "__of", key, "__n").select(F.col("block").alias("__block"), F.col("words").alias("__words"))
    tested = rows.where(F.col(key).isNotNull()).withColumn("__block", block_of(key, F.lit(blocks).cast("long")))
    passed = tested.join(F.broadcast(sent), "__block").where(passes(key, "__words")).select(*rows.columns)
    # the keys are different ones: an inner join, as the optimizer moves a semi join below the filter
    return passed.join(keys.select(key), key).select(*rows.columns)
