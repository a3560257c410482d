"""Vector code compression: product quantisation with whole-number codebooks,
nearest entries found by slice-and-intersect bitmasks.

A vector is cut into equal consecutive parts, and each part is stored as the
number of the nearest entry of its position's codebook. The search in one
codebook:

* Slices: in each dimension the entries are sorted by their coordinate, and
  the k-th prefix of this order carries a mask (64-bit words, one bit for
  each entry) of the entries in it. Two binary searches and one AND NOT give
  the entries whose coordinate lies within a radius of the vector's.
* Intersection: the masks of all dimensions, ANDed, are exactly the entries
  in the box of that radius around the vector.
* Radius: the distance to the nearest of a few entries (pivots) bounds the
  distance to the nearest of all, which so lies in the box of that radius.
  The entries in the box are compared exactly, ties go to the lower number.

All numbers are integers, so that rounds agree whatever the partitions.
Training: each round is one pass over the vectors. A task adds up its own
vectors for each entry, Spark adds the tasks' sums, and the driver gets one
number for each codebook coordinate (entries x dimensions, fixed by the
parameters). Vectors that are equal or share a label cost nothing extra: no
step deals rows out by vector; error sums by label are combined in the map
tasks, and the join that hands them back is planned by Spark on measured
sizes, which splits a label that holds much of the table.

Defined cases: vectors that are null or hold a null, NaN or infinite number
are dropped. Vectors of different lengths count as filled up with zeros to
the longest one, and that to a multiple of the number of parts. Coordinates
beyond ``REACH`` in magnitude count as ``REACH`` (their squares would leave
64 bits). Null ``vec_id`` come last when the first entries are chosen; rows
repeated with one ``vec_id`` are ordered by their vector, each gives a row. With
fewer vectors than entries the codebook is as much smaller. Null labels are
one label. An empty table gives an empty result. Extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.shared import write_shared

SCALE = 1024
REACH = 1 << 27
ROWS_AT_ONCE = 2048
PAIRS_AT_ONCE = 1 << 15
PIVOTS = 16


# -- the search in one codebook ----------------------------------------------------

class SlicedBook:
    """A codebook (entries x width, int64) with sorted slices and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.n, self.width = entries.shape
        words = -(-self.n // 64)
        bit = np.zeros((self.n, words), np.uint64)
        bit[np.arange(self.n), np.arange(self.n) // 64] = np.uint64(1) << (np.arange(self.n) % 64).astype(np.uint64)
        self.sorted, self.prefix = [], []
        for d in range(self.width):
            order = np.argsort(entries[:, d], kind="stable")
            self.sorted.append(entries[order, d])
            masks = np.zeros((self.n + 1, words), np.uint64)
            np.bitwise_or.accumulate(bit[order], axis=0, out=masks[1:])
            self.prefix.append(masks)
        # a few entries from all over the codebook, to bound the first radius
        self.pivots = entries[np.unique(np.linspace(0, self.n - 1, min(self.n, PIVOTS)).astype(np.int64))]

    def first_radius(self, x: np.ndarray) -> np.ndarray:
        """Distance of each row to the nearest pivot, rounded up: the box of that radius holds the nearest entry."""
        least = np.full(len(x), np.iinfo(np.int64).max)
        for p in self.pivots:
            diff = x - p
            np.minimum(least, np.einsum("ij,ij->i", diff, diff, dtype=np.int64), out=least)
        return np.array([isqrt(v) + 1 for v in least.tolist()], np.int64)

    def in_box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask words (rows x words) of the entries within ``radius`` of each row in every dimension."""
        found = None
        for d in range(self.width):
            low = np.searchsorted(self.sorted[d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[d], x[:, d] + radius, "right")
            hits = self.prefix[d][high] & ~self.prefix[d][low]
            found = hits if found is None else found & hits
        if found is None:  # parts without dimensions: every entry
            found = np.repeat(np.bitwise_or.reduce(self._all(), axis=0, keepdims=True), len(x), axis=0)
        return found

    def _all(self) -> np.ndarray:
        bits = np.zeros(-(-self.n // 64) * 64, np.uint8)
        bits[:self.n] = 1
        return np.packbits(bits, bitorder="little").view("<u8").reshape(1, -1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``x`` (rows x width, int64)."""
        entry, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        most = max(abs(int(v)) for m in (x, self.entries) for v in (m.min(initial=0), m.max(initial=0)))
        if (2 * most) ** 2 * max(1, self.width) < 1 << 31:  # half the bytes to move, as exact
            x = x.astype(np.int32)
        for at in range(0, len(x), ROWS_AT_ONCE):
            rows = x[at:at + ROWS_AT_ONCE]
            masks = self.in_box(rows, self.first_radius(rows))
            bits = np.unpackbits(masks.view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
            entry[at:at + len(rows)], best[at:at + len(rows)] = self._least(rows, bits)
        return entry, best

    def _least(self, rows: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact comparison of the candidates: (entry, distance); every row has one at least."""
        entry, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        entries = self.entries.astype(rows.dtype)
        sizes = bits.sum(axis=1, dtype=np.int64)
        ends = np.cumsum(sizes)
        lo = 0
        while lo < len(rows):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, "right")))
            r, e = np.nonzero(bits[lo:hi])
            diff = rows[lo:hi][r] - entries[e]
            d = np.einsum("ij,ij->i", diff, diff)
            starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            least = np.minimum.reduceat(d, starts)
            hit = np.flatnonzero(d == np.repeat(least, np.diff(np.append(starts, len(r)))))
            first = hit[np.concatenate(([True], r[hit][1:] != r[hit][:-1]))]  # ties: the lower number
            entry[lo:hi], best[lo:hi] = e[first], least
            lo = hi
        return entry, best


# -- Spark -------------------------------------------------------------------------

def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x (array of longs) of the rows that are not dropped."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(REACH))), F.lit(-float(REACH)))))
    kept = table.where(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select("vec_id", "label", whole.alias("x"))


def _matrix(column, dims: int) -> np.ndarray:
    """An Arrow list column as rows x dims, short rows filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), dims), np.int64)
    if len(sizes) and (sizes == dims).all():
        out[:] = flat[offsets[0]:offsets[-1]].reshape(-1, dims)
    else:
        for i, n in enumerate(sizes):
            out[i, :n] = flat[offsets[i]:offsets[i] + n]
    return out


def _sums(books: list[np.ndarray], dims: int):
    """mapInArrow function: each task's sums (part, entry, place, total, n), once."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        sliced = [SlicedBook(b) for b in books]
        width = dims // len(books)
        total = np.zeros((len(books), len(books[0]), width + 1), np.int64)  # last place: how many
        for b in batches:
            x = _matrix(b.column(0), dims)
            for p, book in enumerate(sliced):
                own = x[:, p * width:(p + 1) * width]
                entry, _ = book.nearest(own)
                np.add.at(total[p], entry, np.concatenate((own, np.ones((len(own), 1), np.int64)), axis=1))
        part, entry, place = np.nonzero(np.broadcast_to(total[:, :, -1:] > 0, total.shape))
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(place.astype(np.int32)),
                                              pa.array(total[part, entry, place])], ["part", "entry", "place", "total"])

    return run


def next_books(kept: DataFrame, books: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """Each entry becomes the floor of the mean of the parts nearest to it."""
    sums = kept.select("x").mapInArrow(_sums(books, dims), "part int, entry int, place int, total long")
    found = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).toArrow()
    width = dims // len(books)
    total = np.zeros((len(books), len(books[0]), width + 1), np.int64)
    cols = [found.column(c).to_numpy() for c in ("part", "entry", "place", "total")]
    total[cols[0], cols[1], cols[2]] = cols[3]
    out = []
    for book, own in zip(books, total):
        used = own[:, -1] > 0
        new = book.copy()
        new[used] = own[used, :-1] // own[used, -1:]  # floor division
        out.append(new)
    return out


def _codes(books: list[np.ndarray], dims: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        sliced = [SlicedBook(b) for b in books]
        width = dims // len(books)
        for b in batches:
            x = _matrix(b.column(2), dims)
            error = np.zeros(len(x), np.int64)
            code = np.zeros((len(x), len(books)), np.uint8)
            for p, book in enumerate(sliced):
                entry, d = book.nearest(x[:, p * width:(p + 1) * width])
                error += d
                code[:, p] = entry
            text = [row.tobytes().hex() for row in code]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def compress(table: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every vector that is not dropped, and
    the codebooks (entries x width for each part). ``entries`` is 256 at
    most: a code has two hex digits for each part."""
    if not 0 < entries <= 256:
        raise ValueError("a code digit pair holds 256 entries at most")
    spark = table.sparkSession
    kept = write_shared(whole_vectors(table), "vectors")
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    longest = kept.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], schema), []
    dims = -(-longest // parts) * parts
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = np.zeros((len(first), dims), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r["x"])] = r["x"]
    width = dims // parts
    books = [start[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    for _ in range(rounds):
        books = next_books(kept, books, dims)
    return kept.select("vec_id", "label", "x").mapInArrow(_codes(books, dims), schema), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' coordinates by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def restore(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """vec_id and the vector that its code stands for: the middle of each coordinate's step."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            digits = np.frombuffer(b"".join(bytes.fromhex(c) for c in b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, len(books))
            x = np.concatenate([book[digits[:, p]] for p, book in enumerate(books)], axis=1)
            vectors = pa.array(list((x + 0.5) / scale), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), vectors], ["vec_id", "embedding"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, embedding array<double>")


def code_report(table: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector."""
    coded, books = compress(table, parts, entries, rounds)
    coded = write_shared(coded, "vector-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own_label")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("own_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
