"""Line dedup: near-copies of lines over all documents, one occurrence kept.

1. Lines are normalised: lower case, digit runs to one 0, all that is no
   letter or digit to single blanks. A line of which nothing is left is never
   a copy. Equal lines (by the MD5 of the normalised line) are one.
2. Each different line has a 64-bit SimHash of its words of over five bytes
   (of all its words where it has no such one): the short words that most
   lines share would make unlike lines look alike. Two lines link if
   their fingerprints differ in at most 3 bits and the edit distance of the
   normalised lines is at most 20 % of the longer one.
3. Candidates: of five blocks two at least are equal where at most three bits
   differ, so fingerprints are joined on each of the ten pairs of blocks. The
   join works on different fingerprints, packed as bytes by slots of the key
   range (their number follows the number of fingerprints); a slot's task
   keeps those that have a partner within three bits in their bucket, and
   unlike lines that share a bucket by chance end there. Buckets of over
   1,024 fingerprints are passed on whole.
4. A bucket of n lines is not expanded to its pairs. First every member is
   compared with the bucket's first line. Components of what links so far
   leave most buckets with one component: these are done. In the others the
   members outside the largest component are compared with the members of
   other components. Lines of equal fingerprint are a bucket too. No pair of
   lines of different components is left out, so the final components are exact.
5. Of each group the first occurrence stays: least ``doc_id``, then place,
   then the MD5 of the normalised line, then the row. Rows are numbered as the
   lines are written, so unlike texts of one ``doc_id`` (or of none) are told apart.

Defined cases: a null text counts as empty. Null ``doc_id`` come first.
Repeated rows are documents of their own: of their lines one stays. Lines are
compared whole, whatever their length. An empty table gives an empty result.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from itertools import chain, combinations, repeat
from os.path import commonprefix

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.components import connected_components
from forgeline.llm.shared import text_or_empty, write_shared

MAX_BITS = 3
BLOCKS = (13, 13, 13, 13, 12)
SIMILARITY = 0.8
SEED = 42
SHORT_WORD = 5
#: fingerprints in a slot of the block join, on average
SLOT = 1 << 18
#: bytes of lines that a task holds as Python objects at once
LINE_BYTES = 1 << 19
LARGE_RUN = 1024
#: Latin letters up to U+017F and general punctuation: every Unicode version agrees on what is a
#: letter there and on its lower case, which lies there too (but that of U+0130)
AGREED = r"\x{00}-\x{12F}\x{131}-\x{17F}\x{2000}-\x{206F}"
_KEPT = [c for c in map(chr, range(0x180)) if unicodedata.category(c)[0] in "LN"]
_WORDS = re.compile("[" + "".join(_KEPT) + "]+").findall
_BYTES = bytes(ord("0") if 48 <= i < 58 else i if i == 10 or i < 128 and chr(i) in _KEPT else 32 for i in range(256))
#: the bits of a byte as eight bytes
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
BUCKET = ["pair", "bits"]


def normalised(line: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), r"[^\p{L}\p{N}]+", " ")
    return F.trim(bare)


def agreed(line: Column) -> Column:
    """Whether ``normalised_agreed`` gives what ``normalised`` gives."""
    return (F.octet_length(line) == F.length(line)) | ~line.rlike(f"[^{AGREED}]")


def normalised_lines(text: bytes) -> list[bytes]:
    """``normalised`` of each line of a text of the characters that ``AGREED`` has."""
    if text.isascii():
        text = text.lower().translate(_BYTES)
        if b"00" in text:
            text = re.sub(b"00+", b"0", text)
        return [b" ".join(line.split()) for line in text.split(b"\n")]
    bare = re.sub("[0-9]+", "0", text.decode(errors="replace").lower())
    return [" ".join(_WORDS(line)).encode() for line in bare.split("\n")]


def normalised_agreed(line: bytes) -> bytes:
    return normalised_lines(line)[0]


def lines_of(docs: DataFrame, *columns) -> DataFrame:
    """Every line: ``columns``, line_no (from 0), line."""
    return docs.select(*columns, F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("line_no", "line"))


def simhashes(lines: list[bytes]) -> np.ndarray:
    """64-bit SimHash of each line's words (blank-separated, one at least); a
    bit is set if it is set in over half the words' hashes."""
    import xxhash

    words = []
    for line in lines:
        own = line.split(b" ")
        words.append([w for w in own if len(w) > SHORT_WORD] or own)
    sizes = np.array([len(w) for w in words])
    out = np.zeros(len(lines), np.uint64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(lines):  # slices of about 2**13 words
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 13))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words[at:to]), repeat(SEED)), np.uint64)
        starts = np.cumsum(sizes[at:to]) - sizes[at:to]
        if sizes[at:to].max() < 256:  # a byte of the sum for each bit
            ones = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], starts, axis=0).view(np.uint8).astype(np.int32)
        else:
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[at:to] = np.packbits(ones * 2 > sizes[at:to, None], axis=1, bitorder="little").view("<u8")[:, 0]
        at = to
    return out


def line_occurrences(docs: DataFrame, row: Column) -> DataFrame:
    """doc_id, row, line_no, raw (hash of the line as it is), md5, fp of every
    line that has a word; ``row`` differs from row to row of ``docs``."""
    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            at, places, raws, texts, held = [], [], [], [], 0

            def found():
                own = pa.array(at, pa.int64())
                md5 = pa.array([hashlib.md5(t).digest() for t in texts], pa.binary())
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(own), b.column(1).take(own), pa.array(places, pa.int32()), pa.array(raws, pa.int64()), md5, pa.array(simhashes(texts).view(np.int64))],
                    ["doc_id", "row", "line_no", "raw", "md5", "fp"])

            for i, (text, odd) in enumerate(zip(b.column(2), b.column(3))):
                text, odd = text.as_py(), odd.as_py()
                lines = text.split(b"\n")
                if odd is None:
                    bare = normalised_lines(text)
                else:
                    bare = [normalised_agreed(line) if o["bare"] is None else o["bare"].encode() for line, o in zip(lines, odd)]
                for no, (line, norm) in enumerate(zip(lines, bare)):
                    if norm:
                        at.append(i)
                        places.append(no)
                        raws.append((xxhash.xxh64_intdigest(line, SEED) ^ 1 << 63) - (1 << 63) if odd is None else odd[no]["raw"])
                        texts.append(norm)
                        held += len(line)
                        if held >= LINE_BYTES:  # so many bytes of lines at once
                            yield found()
                            at, places, raws, texts, held = [], [], [], [], 0
            if texts:
                yield found()

    kind = docs.schema["doc_id"].dataType.simpleString()
    # the task's Python normalises lines of agreed characters; texts that have others come with what Spark makes of such lines
    odd = F.transform(F.split("text", "\n", -1), lambda line: F.struct(F.xxhash64(line).alias("raw"), F.when(~agreed(line), normalised(line)).alias("bare")))
    rows = docs.select("doc_id", row.alias("row"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", "row", F.col("text").cast("binary").alias("whole"), F.when(~agreed(F.col("text")), odd).alias("odd"))
    return rows.mapInArrow(run, f"doc_id {kind}, row long, line_no int, raw long, md5 binary, fp long")


def block_pairs() -> list[tuple[int, int, int, int]]:
    """(shift, width) of both blocks of each pair of blocks."""
    ends = np.cumsum(BLOCKS)
    at = [(int(64 - end), width) for end, width in zip(ends, BLOCKS)]
    return [(*at[i], *at[j]) for i, j in combinations(range(len(BLOCKS)), len(BLOCKS) - MAX_BITS)]


def block_bits(prints: np.ndarray, pair: int) -> np.ndarray:
    """The bits of the two blocks of pair number ``pair``, as one number."""
    shift, width, shift2, width2 = (np.uint64(v) for v in block_pairs()[pair])
    one = np.uint64(1)
    first = (prints >> shift) & ((one << width) - one)
    return (first << width2) | ((prints >> shift2) & ((one << width2) - one))


def near_in_runs(prints: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, print, lead) of each print with a partner within ``MAX_BITS``
    among those of equal ``bits``; ``lead`` is the least such print there."""
    order = np.lexsort((prints, bits))
    f, k = prints[order], bits[order]
    run = np.cumsum(np.r_[False, k[1:] != k[:-1]])
    size = np.bincount(run)
    end = np.cumsum(size)[run]
    hit = (size > LARGE_RUN)[run]
    left, step = np.flatnonzero(~hit), 1
    while True:
        left = left[left + step < end[left]]
        if not left.size:
            break
        near = left[np.bitwise_count(f[left] ^ f[left + step]) <= MAX_BITS]
        hit[near] = hit[near + step] = True
        step += 1
    found = np.flatnonzero(hit)
    _, first, of = np.unique(run[found], return_index=True, return_inverse=True)
    return k[found], f[found], f[found[first]][of] if found.size else f[found]


def near_prints(prints: DataFrame) -> DataFrame:
    """pair, bits, fp, lead: the buckets (pair of blocks, their bits) of
    ``prints`` (fp: long, all different), of the members that have a partner."""
    pairs = len(block_pairs())
    slots = prints.count() // SLOT + 1

    def pack(batches):
        import pyarrow as pa

        for b in batches:
            own = b.column(0).to_numpy().view(np.uint64)
            slot, packed = [], []
            for pair in range(pairs):
                at = (block_bits(own, pair) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(slots)
                order = np.argsort(at, kind="stable")
                ids, starts = np.unique(at[order], return_index=True)
                slot.extend(int(i) * pairs + pair for i in ids)
                packed.extend(part.tobytes() for part in np.split(own[order], starts[1:]) if part.size)
            yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(packed, pa.binary())], ["slot", "packed"])

    def members(table):
        import pyarrow as pa

        pair = table.column("slot")[0].as_py() % pairs
        own = np.frombuffer(b"".join(table.column("packed").to_pylist()), np.uint64)
        bits, f, lead = near_in_runs(own, block_bits(own, pair))
        return pa.table({"pair": pa.array(np.full(len(f), pair), pa.int32()), "bits": bits.view(np.int64),
                         "fp": f.view(np.int64), "lead": lead.view(np.int64)})

    packed = prints.select("fp").mapInArrow(pack, "slot long, packed binary")
    return packed.groupBy("slot").applyInArrow(members, "pair int, bits long, fp long, lead long")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``: what both ends share is
    taken off, then a column of the distance table is one step on bits
    (Myers 1999): where the distance grows and where it falls down the column."""
    if abs(len(a) - len(b)) > most:
        return False
    first = len(commonprefix((a, b)))
    a, b = a[first:], b[first:]
    last = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[:len(a) - last], b[:len(b) - last]
    if len(a) > len(b):
        a, b = b, a
    if len(b) <= most:
        return True
    if not a:
        return False
    # a bit for each place of a character
    codes, of = np.unique(np.array([a]).view(np.uint32), return_inverse=True)
    bits = np.packbits(of == np.arange(len(codes))[:, None], axis=1, bitorder="little")
    places = {chr(c): int.from_bytes(own.tobytes(), "little") for c, own in zip(codes.tolist(), bits)}
    full, top, now = (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    grows, falls = full, 0
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        equal = places.get(c, 0)
        down = equal | falls
        across = ((equal & grows) + grows ^ grows) | equal
        up = falls | full & ~(across | grows)
        fall = grows & across
        if up & top:
            now += 1
            if now - left > most:
                return False
        elif fall & top:
            now -= 1
        up = up << 1 | 1
        grows = full & (fall << 1 | ~(down | up))
        falls = up & down & full
    return now <= most


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose lines pass the edit distance."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            passed = [within(x.as_py(), y.as_py(), most.as_py()) for x, y, most in zip(b.column(2), b.column(3), b.column(4))]
            yield b.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    most = F.floor(F.greatest(F.length("x"), F.length("y")) * F.lit(round(1 - SIMILARITY, 6))).cast("int").alias("most")
    return both.select("a", "b", "x", "y", most).mapInArrow(run, "a long, b long")


def line_groups(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, row, line_no, first_doc, first_line, kept for every line that has
    a copy (itself among them): its group's first occurrence and whether it is
    it. ``row`` numbers the rows of ``docs``; by default they are numbered here."""
    lines = write_shared(line_occurrences(docs, F.monotonically_increasing_id() if row is None else row), "lines")
    place = F.struct("doc_id", "line_no", "md5", "row", "raw")
    distinct = lines.groupBy("md5", "fp").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    # the numbers hold once they are written
    distinct = write_shared(distinct.withColumn("id", F.monotonically_increasing_id()), "lines-distinct")

    prints = write_shared(distinct.groupBy("fp").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")), "line-prints")
    equal = prints.where("n > 1").select(F.lit(-1).alias("pair"), F.col("fp").alias("bits"), "fp", F.col("fp").alias("lead"))
    buckets = write_shared(near_prints(prints).unionByName(equal), "line-buckets")
    heads = prints.select(F.col("fp").alias("lead"), F.col("head").alias("lead_id"))
    members = write_shared(buckets.join(heads, "lead").join(distinct.select("id", "fp"), "fp"), "line-members")

    ids = members.select("id").distinct().join(distinct.select("id", "first"), "id")
    # the line as it is must be the same: a place alone can be shared
    ids = ids.select("id", F.struct("first.doc_id", "first.line_no", "first.raw").alias("at"))
    whole = lines_of(docs, "doc_id").select(F.struct("doc_id", "line_no", F.xxhash64("line").alias("raw")).alias("at"), "line")
    texts = whole.join(ids, "at").dropDuplicates(["id"]).select("id", normalised(F.col("line")).alias("line"))
    texts = write_shared(texts, "line-texts")

    with_first = members.where("id <> lead_id").where(_near("fp", "lead"))
    links = write_shared(similar(with_first.select(F.col("lead_id").alias("a"), F.col("id").alias("b")).distinct(), texts), "line-links")

    found = connected_components(links)
    labelled = members.join(found, "id", "left").select(*BUCKET, "id", "fp", F.coalesce("component", "id").alias("label"))
    labelled = write_shared(labelled, "line-labels")
    per = labelled.groupBy(*BUCKET, "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("labels"), F.max_by("label", F.struct("n", "label")).alias("most")).where("labels > 1")
    mixed = labelled.join(mixed.select(*BUCKET, "most"), BUCKET)
    few = mixed.where("label <> most").select(*BUCKET, F.col("id").alias("a"), F.col("fp").alias("fa"), F.col("label").alias("la"))
    all_ = mixed.select(*BUCKET, F.col("id").alias("b"), F.col("fp").alias("fb"), F.col("label").alias("lb"))
    more = few.join(all_, BUCKET).where((F.col("la") != F.col("lb")) & _near("fa", "fb")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = write_shared(links.unionByName(similar(more, texts)), "line-links")

    groups = distinct.join(connected_components(links), "id", "left").where("component is not null or n > 1")
    groups = groups.withColumn("group", F.coalesce("component", "id"))
    groups = write_shared(groups.select("md5", "first", "n", "group"), "line-groups")
    firsts = groups.groupBy("group").agg(F.min("first").alias("group_first"), F.sum("n").alias("size")).where("size > 1")
    known = groups.join(firsts, "group").select("md5", F.col("group_first.doc_id").alias("first_doc"), F.col("group_first.line_no").alias("first_line"), F.col("group_first.row").alias("first_row"))
    kept = (F.col("row") == F.col("first_row")) & (F.col("line_no") == F.col("first_line"))
    return lines.join(known, "md5").select("doc_id", "row", "line_no", "first_doc", "first_line", kept.alias("kept"))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped (places of the dropped lines,
    ascending, comma-joined) for each ``doc_id``; rows that share one are one document."""
    gone = line_groups(docs).where("not kept").groupBy("doc_id").agg(F.array_sort(F.collect_list("line_no")).alias("places"))
    gone = gone.select(F.struct("doc_id").alias("k"), F.size("places").cast("long").alias("n_dropped"), F.array_join(F.col("places").cast("array<string>"), ",").alias("dropped"))
    n = F.size(F.split(text_or_empty(), "\n", -1)).cast("long")
    rows = docs.groupBy("doc_id").agg(F.sum(n).alias("n_lines")).withColumn("k", F.struct("doc_id"))
    return rows.join(gone, "k", "left").select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), F.coalesce("dropped", F.lit("")).alias("dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``. The rows are
    written once with their numbers, so ``doc_id`` may be null or repeated."""
    rows = write_shared(docs.select(F.struct("*").alias("__whole"), F.monotonically_increasing_id().alias("__row")), "line-docs")
    named = rows.select(F.col("__whole.doc_id").alias("doc_id"), F.col("__whole.text").alias("text"), "__row")
    gone = line_groups(named, F.col("__row")).where("not kept").groupBy("row").agg(F.collect_set("line_no").alias("__places"))
    rows = rows.join(gone, rows["__row"] == gone["row"], "left")
    left = F.filter(F.split("__whole.text", "\n", -1), lambda line, i: ~F.array_contains("__places", i))
    text = F.when(F.col("__places").isNull(), F.col("__whole.text")).otherwise(F.array_join(left, "\n"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("__whole")[c].alias(c) for c in docs.columns])
