"""SimHash near-dedup: a self-join of distinct fingerprints by binary tries.

Fingerprints: 64 bits; bit i is set if it is set in over half the XXH64 hashes
of the text's word shingles.

The join walks pairs of trie nodes together, adds up the bits in which their
prefixes differ and prunes a pair whose sum exceeds the error budget. With
budget k the 64 bits are cut into k + 1 blocks; of any two fingerprints that
differ in at most k bits, some rotation of the blocks has at most
``floor(j * k / (k + 1))`` differing bits in its first j blocks, for every j
(the cycle lemma). So each rotation's trie is walked with that tight budget,
which grows block by block, and together they miss no pair. The first block
has budget 0: node pairs there are equal prefixes, and Spark deals the
fingerprints out by (rotation, prefix). A prefix with more than
``node_rows`` fingerprints is dealt out one block deeper, each of its node
pairs (at most one differing bit) on its own.

A task holds a slice of whole node pairs as sorted arrays: a trie node is a
range in them. It returns a link from each fingerprint to the least one that
its pairs connect it to, not the pairs: a dense ball of n fingerprints gives
n links. Budgets 1, 2, ... k are walked in turn, and a node pair whose leaves
are all in one component already is pruned, so a ball does not cost n * n
either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.components import connected_components
from forgeline.llm.shared import text_or_empty, write_shared

SEED = 42
BITS = 64
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one text (UTF-8): A-Z lower-cased, words are what is
    between ASCII white space; 0 for a text without words."""
    import xxhash

    words = text.lower().split()  # of bytes: exactly A-Z, and exactly 20 and 09 to 0D
    if not words:
        return 0
    if len(words) < shingle:
        shingle = len(words)
    total, n = np.zeros(BITS, np.int64), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, HASHES_AT_ONCE):
        part = words[at:min(n, at + HASHES_AT_ONCE) + shingle - 1]
        joined = map(b" ".join, zip(*[part[i:] for i in range(shingle)]))
        hashes = np.array([digest(s, SEED) for s in joined], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def _stand_in() -> Column:
    """What tells rows of one ``doc_id``, or of none, apart: the hash of their text."""
    return F.xxhash64(text_or_empty())


def _least_row(frame_id: str, stand_in: str) -> Column:
    """The least row of a group: by ``doc_id``, nulls last, then by the hash of the text."""
    return F.min(F.struct(F.col(frame_id).isNull().alias("none"), F.col(frame_id).alias("id"), F.col(stand_in).alias("text")))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, stand_in, fp as a signed long) for each row of ``docs``."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "stand_in", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _stand_in().alias("stand_in"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, stand_in long, fp long")


# -- the walk inside a task ----------------------------------------------------

def blocks_of(budget: int) -> list[int]:
    """Widths of the budget + 1 blocks."""
    m = budget + 1
    return [BITS // m + (i < BITS % m) for i in range(m)]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Least index of the component of each of n items, given ``label`` so far and links a-b."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        x, y = x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


class _Slice:
    """Sorted fingerprints of one task's node pairs, and their components."""

    LEAF_PAIRS = 64
    PAIRS_AT_ONCE = 1 << 18

    def __init__(self, group: np.ndarray, fp: np.ndarray, budget: int):
        self.fp, self.n, self.budget = fp, len(fp), budget
        self.label = np.arange(self.n)
        self.cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        ones = []
        for bit in range(BITS):  # ones before each place, from the highest bit
            is_set = (fp >> np.uint64(BITS - 1 - bit)) & np.uint64(1)
            ones.append(np.concatenate(([0], np.cumsum(is_set, dtype=np.int32))).astype(np.int32))
        self.ones = ones

    def _same(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The component of all leaves of each range, -1 where they differ."""
        first = self.label[lo]
        changes = self.changes
        return np.where(changes[hi - 1] == changes[lo], first, -1)

    def link(self, starts: list[tuple], limits: list[int]) -> None:
        """Walk from ``starts`` (a_lo, a_hi, b_lo, b_hi, depth arrays) under the limit of differing bits at each depth."""
        self.changes = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))
        found_a, found_b = [], []
        todo = list(starts)
        while todo:
            al, ah, bl, bh, depth, err = todo.pop()
            if len(al) > self.PAIRS_AT_ONCE:
                half = len(al) // 2
                todo += [(al[:half], ah[:half], bl[:half], bh[:half], depth, err[:half]), (al[half:], ah[half:], bl[half:], bh[half:], depth, err[half:])]
                continue
            one = self._same(al, ah)
            open_ = (one < 0) | (one != self._same(bl, bh))
            al, ah, bl, bh, err = (x[open_] for x in (al, ah, bl, bh, err))
            few = ((ah - al) * (bh - bl) <= self.LEAF_PAIRS) | (depth >= BITS)
            if few.any():
                a, b = self._leaves(al[few], ah[few], bl[few], bh[few])
                near = _popcount(self.fp[a] ^ self.fp[b]) <= limits[-1]
                found_a.append(a[near])
                found_b.append(b[near])
            al, ah, bl, bh, err = (x[~few] for x in (al, ah, bl, bh, err))
            if not len(al):
                continue
            ones, limit = self.ones[depth], limits[depth]
            am, bm = ah - (ones[ah] - ones[al]), bh - (ones[bh] - ones[bl])
            self_pair = (al == bl) & (ah == bh)
            kids = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1), (am, ah, bl, bm, err + 1)]
            parts = []
            for i, (p, q, r, s, e) in enumerate(kids):
                ok = (q > p) & (s > r) & (e <= limit)
                if i == 3:
                    ok &= ~self_pair  # the mirror image of the third
                if ok.any():
                    parts.append((p[ok], q[ok], r[ok], s[ok], e[ok]))
            if parts:
                p, q, r, s, e = (np.concatenate(x) for x in zip(*parts))
                todo.append((p, q, r, s, depth + 1, e))
        if found_a:
            self.label = _components(self.n, np.concatenate(found_a), np.concatenate(found_b), self.label)

    @staticmethod
    def _leaves(al, ah, bl, bh):
        """All index pairs of each pair of ranges (each unordered pair once)."""
        na, nb = ah - al, bh - bl
        size = na * nb
        which = np.repeat(np.arange(len(size)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        a, b = al[which] + at // nb[which], bl[which] + at % nb[which]
        keep = a < b
        return a[keep], b[keep]


def link_slice(group: np.ndarray, side: np.ndarray, fp: np.ndarray, first_bits: int, block_ends: list[int], budget: int) -> np.ndarray:
    """Index of the least fingerprint that each one is connected to within its group.

    ``group`` is ascending, then ``side``, then ``fp`` (rotated). A group of
    side 0 is one node paired with itself; sides 1 and 2 are two nodes whose
    prefixes differ in one bit, and only pairs across them are walked.
    """
    s = _Slice(group * 3 + side, fp, budget)
    lo, hi = s.cut[:-1], s.cut[1:]
    own, sides = group[lo], side[lo]
    two = np.flatnonzero((own[1:] == own[:-1]) & (sides[:-1] == 1))
    alone = np.flatnonzero(sides == 0)
    al, ah = np.concatenate((lo[alone], lo[two])), np.concatenate((hi[alone], hi[two]))
    bl, bh = np.concatenate((lo[alone], lo[two + 1])), np.concatenate((hi[alone], hi[two + 1]))
    err = np.concatenate((np.zeros(len(alone), np.int64), np.ones(len(two), np.int64)))
    for k in range(1, budget + 1) if budget else [0]:
        limits = []
        for bit in range(BITS):
            j = next(i for i, end in enumerate(block_ends) if bit < end)
            limits.append(min(k, (j + 1) * budget // (budget + 1)))
        limits.append(k)
        s.link([(al, ah, bl, bh, first_bits, err)], limits)
    return s.label


def _walk(budget: int, batch_rows: int):
    """mapInArrow function over rows (node, side, rotated, fp), sorted by node, side, rotated."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        held: list[tuple] = []
        rows = 0

        def done(parts):
            key, side, rot, fp = (np.concatenate(x) for x in zip(*parts))
            turn = key >> 60
            out = []
            for r in np.unique(turn):  # each rotation has its own order of the blocks
                at = turn == r
                widths = blocks_of(budget)
                order = widths[int(r):] + widths[:int(r)]
                ends = list(np.cumsum(order))
                deep = (key[at] >> 59) & 1
                for d in np.unique(deep):
                    here = np.flatnonzero(at)[deep == d]
                    _, group = np.unique(key[here], return_inverse=True)
                    first = ends[1] if d and len(ends) > 1 else ends[0]
                    least = link_slice(group, side[here], rot[here], first, ends, budget)
                    linked = least != np.arange(len(least))
                    out.append((fp[here][linked], fp[here][least[linked]]))
            a = np.concatenate([x for x, _ in out])
            b = np.concatenate([x for _, x in out])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for b in batches:
            key, side = b.column(0).to_numpy(), b.column(1).to_numpy()
            held.append((key, side.astype(np.int64), b.column(2).to_numpy().view(np.uint64), b.column(3).to_numpy()))
            rows += len(key)
            if rows < batch_rows:
                continue
            parts = [np.concatenate(x) for x in zip(*held)]
            key = parts[0]
            end = int(np.searchsorted(key, key[-1]))  # the last node pair may go on
            if end:
                yield done([tuple(x[:end] for x in parts)])
            held, rows = [tuple(x[end:] for x in parts)], len(key) - end
        if rows:
            yield done(held)

    return run


def near_links(distinct: DataFrame, budget: int, node_rows: int = 50_000, batch_rows: int = 100_000) -> DataFrame:
    """``distinct`` (fp: long, all different) to links (a, b) that connect any
    two fingerprints with at most ``budget`` differing bits."""
    if budget == 0:  # they are all different
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    widths = blocks_of(budget)
    fp = F.col("fp")
    turns, at = [], 0
    for r, width in enumerate(widths):
        rotated = fp if not at else F.shiftleft(fp, at).bitwiseOR(F.shiftrightunsigned(fp, BITS - at))
        second = widths[(r + 1) % len(widths)]
        turns.append(F.struct(F.lit(r).cast("long").alias("r"), rotated.alias("rotated"),
                              F.shiftrightunsigned(rotated, BITS - width).alias("prefix"),
                              F.lit(BITS - width - second).alias("deep_shift"), F.lit(second).alias("second")))
        at += width
    rows = distinct.select("fp", F.explode(F.array(*turns)).alias("t")).select("fp", "t.*")
    # prefixes with too many fingerprints; few, since fingerprints are distinct
    full = rows.groupBy("r", "prefix").count().where(F.col("count") > node_rows).select("r", "prefix", F.lit(True).alias("full"))
    rows = rows.join(full, ["r", "prefix"], "left")
    plain = rows.where("full is null").select(
        (F.shiftleft("r", 60) + F.col("prefix")).alias("node"), F.lit(0).alias("side"), "rotated", "fp")
    deep = F.expr("shiftrightunsigned(rotated, deep_shift)")
    flips = F.expr("transform(sequence(-1, second - 1), i -> if(i < 0, 0L, shiftleft(1L, i)))")
    other = rows.where("full").withColumn("own", deep).withColumn("flip", F.explode(flips))
    # of a node pair, the row's own prefix is the lesser (side 1) or the greater (side 2)
    pair = F.least(F.col("own"), F.col("own").bitwiseXOR(F.col("flip")))
    node = F.shiftleft("r", 60) + F.lit(1 << 59) + F.xxhash64(pair, "flip").bitwiseAND(F.lit((1 << 59) - 1))
    side = F.when(F.col("flip") == 0, 0).when(pair == F.col("own"), 1).otherwise(2)
    dealt = plain.unionByName(other.select(node.alias("node"), side.alias("side"), "rotated", "fp"))
    # unsigned order of the rotated bits: flip the sign for the sort
    dealt = dealt.repartition("node").sortWithinPartitions("node", "side", F.col("rotated").bitwiseXOR(F.lit(-(1 << 63))))
    return dealt.mapInArrow(_walk(budget, batch_rows), "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, **params) -> DataFrame:
    """doc_id, fp (signed long), component_id: the least ``doc_id`` reachable
    over links of at most ``max_bits`` differing bits, itself included.

    Defined cases: a null text counts as empty; texts without words have
    fingerprint 0 and link like any other; null ``doc_id`` rows get a
    component but never name one, unless it has no other. Repeated rows each
    give a row. An empty table gives an empty result. Extra columns are not
    read, whatever their names. Long texts are hashed in slices, whole.
    """
    docs_fp = write_shared(fingerprints(docs, shingle), "simhash")
    distinct = write_shared(docs_fp.groupBy("fp").agg(_least_row("doc_id", "stand_in").alias("row")).select(
        "fp", F.col("row.id").alias("least"), F.col("row.text").alias("stand_in")), "simhash-distinct")
    nodes = connected_components(near_links(distinct.select("fp"), max_bits, **params))
    joined = distinct.join(nodes.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    joined = write_shared(joined, "simhash-components")
    least = joined.groupBy("component").agg(_least_row("least", "stand_in").alias("row")).select(
        "component", F.col("row.id").alias("component_id"), F.col("row.text").alias("component_stand_in"))
    known = joined.select("fp", "component").join(least, "component").drop("component")
    return docs_fp.join(known, "fp").select("doc_id", "fp", "component_id", "component_stand_in")


def keep_one_of_each(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the least
    ``doc_id`` (null ones last), of rows with one id the one whose text has the
    least hash. A row is named by its id and its text, so that unlike texts under
    one id are rows of their own; of rows repeated with both, one stays."""
    stay = simhash_groups(docs, **params).select(
        F.struct(F.col("component_id").alias("i"), F.col("component_stand_in").alias("s")).alias("__doc")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), F.struct(F.col("doc_id").alias("i"), _stand_in().alias("s")).alias("__doc"))
    return rows.join(stay, "__doc", "left_semi").dropDuplicates(["__doc"]).select("__row.*")
