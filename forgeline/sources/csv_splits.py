"""CSV files with quoted line ends, read by many tasks.

A line end inside a quoted field is no record end, so where a split of a file
begins can't be told from the split alone. Two passes settle it:

1. Each task counts, for every split it reads, the quotes of the lines. With
   doubled quotes a line starts inside a field exactly if the quotes
   before it are odd in number. A split's report says what holds if it starts
   outside a field and what if it starts inside one; the reports of a file (one row for
   each split) are folded in order, which gives the splits that start
   inside a field and the record that they go on with.
2. Each task reads its splits again, now knowing how they start. A line that is
   a record goes straight on; the lines of longer records, and they alone, meet by
   record and are joined by line ends. Every record is then parsed by Spark's own CSV parser.

What the driver holds is the splits that start inside a field, one at most for
each split of the input. A file whose quotes are odd in number is refused.
Lines end with LF or CR LF; both are kept inside fields.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "path string, block long, odd boolean, odd_line boolean, open0 long, open1 long, head string"


class _Scan:
    """Lines of one split in order: whether each starts and ends inside a
    field, and the record it belongs to, as (block, number of its first line)."""

    def __init__(self, block: int, inside: bool, record: tuple[int, int] | None):
        self.block, self.inside, self.record, self.seq = block, inside, record, 0

    def take(self, quotes: int) -> tuple[bool, bool, tuple[int, int]]:
        starts_inside = self.inside
        if not starts_inside:
            self.record = (self.block, self.seq)
        self.inside = starts_inside ^ (quotes % 2 == 1)
        self.seq += 1
        return starts_inside, self.inside, self.record


def _split_lines(batches) -> Iterator[tuple[str, int, int, list, list]]:
    """(path, block, modification time, lines, their quotes), split by split; a split
    comes in pieces, one after the other."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        path, block, mtime, value = b.columns
        quotes = pc.count_substring(value, '"').to_numpy()
        code = path.dictionary_encode().indices.to_numpy()
        starts = block.to_numpy()
        cut = np.flatnonzero((code[1:] != code[:-1]) | (starts[1:] != starts[:-1])) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
            yield path[lo].as_py(), int(starts[lo]), mtime[lo].as_py(), value.slice(lo, hi - lo).to_pylist(), quotes[lo:hi].tolist()


def _reports(lines: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        now, rows = None, []

        def done():
            path, block, outside, inside, head, odd_line = now
            # open: the first line of the record that the split leaves open; -1 if it is still the one it began in
            rows.append((path, block, outside.inside, odd_line, *[(-1 if s.record is None else s.record[1]) if s.inside else None for s in (outside, inside)],
                         "\n".join(head) if block == 0 else None))

        for path, block, _, values, quotes in _split_lines(batches):
            if now is None or now[:2] != [path, block]:
                if now:
                    done()
                now = [path, block, _Scan(block, False, None), _Scan(block, True, None), [], False]
            _, _, outside, inside, head, odd_line = now
            now[5] = odd_line or any(n % 2 for n in quotes)
            for value, n in zip(values, quotes):
                if block == 0 and (not head or (outside.inside and outside.record[1] == 0)):
                    head.append(value)
                outside.take(n)
                inside.take(n)
        if now:
            done()
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip([f.split()[0] for f in REPORT.split(", ")], map(list, zip(*rows)))),
                                             pa.schema([("path", pa.string()), ("block", pa.int64()), ("odd", pa.bool_()), ("odd_line", pa.bool_()), ("open0", pa.int64()),
                                                        ("open1", pa.int64()), ("head", pa.string())]))

    return lines.mapInArrow(run, REPORT)


CARRIED = "path string, block long, rec_block long, rec_seq long"


def _carried(reports: DataFrame) -> DataFrame:
    """The splits that start inside a field, and the record that goes on there;
    ``block`` -1 for a file that ends inside one."""
    def run(table):
        import pyarrow as pa

        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("path", "block", "odd", "open0", "open1"))))
        out, inside, record = [], False, None
        for path, block, odd, open0, open1 in rows:
            if inside:
                out.append((path, block, *record))
            opened = open1 if inside else open0
            inside = inside ^ odd
            if inside and opened is not None and opened >= 0:
                record = (block, opened)
        if inside:
            out.append((path, -1, *record))
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]], [f.split()[0] for f in CARRIED.split(", ")])

    return reports.groupBy("path").applyInArrow(run, CARRIED)


LINES = "path string, mtime long, block long, seq long, rec_block long, rec_seq long, whole boolean, value string"


def _placed(lines: DataFrame, carried: dict) -> DataFrame:
    """Each line with its record; ``whole``: the line is a record by itself."""
    def run(batches):
        import pyarrow as pa

        now, scan = None, None
        for path, block, mtime, values, quotes in _split_lines(batches):
            if now != (path, block):
                now, record = (path, block), carried.get((path, block))
                scan = _Scan(block, record is not None, record)
            seq = list(range(scan.seq, scan.seq + len(values)))
            found = [scan.take(n) for n in quotes]
            n = len(values)
            yield pa.RecordBatch.from_arrays([
                pa.array([path] * n, pa.string()), pa.array([mtime] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(seq, pa.int64()),
                pa.array([r[0] for _, _, r in found], pa.int64()), pa.array([r[1] for _, _, r in found], pa.int64()),
                pa.array([not s and not e for s, e, _ in found], pa.bool_()), pa.array(values, pa.string())],
                [f.split()[0] for f in LINES.split(", ")])

    return lines.mapInArrow(run, LINES)


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files at ``path`` below one header line, every
    field as text, with the columns ``_src_mtime``, ``_src_file``,
    ``_src_offset``, ``_row_seq`` that give their order. Empty lines are
    skipped. Files whose headers differ are refused."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.unix_micros("_metadata.file_modification_time").alias("mtime"), "value")
    reports = _reports(lines).cache()  # one row for each split
    try:
        carried = {(r["path"], r["block"]): (r["rec_block"], r["rec_seq"]) for r in _carried(reports.select("path", "block", "odd", "open0", "open1")).collect()}
        many_lines = reports.where("odd_line").limit(1).count() > 0  # else every line is a record
        heads = [r[0] for r in reports.where("head is not null").select("head").distinct().limit(2).collect()]
    finally:
        reports.unpersist()
    broken = sorted(p for p, block in carried if block == -1)
    if broken:
        raise ValueError(f"a quoted field is not closed in {broken[0]}")
    if len(heads) > 1:
        raise ValueError(f"the headers of the files at {path} differ: {heads[0]!r} and {heads[1]!r}")
    header = next(csv.reader(io.StringIO(heads[0].removeprefix("\ufeff").rstrip("\r"), newline="")), []) if heads else []
    if len(set(header)) != len(header):
        raise ValueError(f"the header at {path} names a column twice")

    placed = _placed(lines, carried)
    first = F.struct(F.col("block"), F.col("seq"))
    single = placed.where("whole").select("path", "mtime", first.alias("at"), F.col("value").alias("record"))
    joined = placed.where("not whole").groupBy("path", "mtime", "rec_block", "rec_seq").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"))
    long = joined.select("path", "mtime", F.struct(F.col("rec_block").alias("block"), F.col("rec_seq").alias("seq")).alias("at"),
                         F.array_join("parts.value", "\n").alias("record"))
    records = single.unionByName(long) if many_lines else single
    records = records.withColumn("record", F.regexp_replace("record", "\r$", ""))
    records = records.where((F.col("record") != "") & ~((F.col("at.block") == 0) & (F.col("at.seq") == 0)))
    names = [f"c{i}" for i in range(len(header))]
    parsed = F.from_csv("record", ", ".join(f"{n} string" for n in names) or "c0 string", {"mode": "FAILFAST", "quote": '"', "escape": '"'})
    rows = records.select(parsed.alias("r"), "path", "mtime", "at")
    return rows.select(*[F.col(f"r.{n}").alias(h) for n, h in zip(names, header)], F.col("mtime").alias("_src_mtime"), F.col("path").alias("_src_file"),
                       F.col("at.block").alias("_src_offset"), F.col("at.seq").alias("_row_seq"))
