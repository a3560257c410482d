"""Removal of long passages that repeat across documents, by sorting suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
in a document with a smaller ``doc_id``. Which strings repeat is read from
a sorted array of the suffixes that start at all their places. Only suffixes
that can match are brought together and sorted:

1. Packing. Tasks write the documents they read in slices of some megabytes
   to the shared folder (Arrow files). Later steps move numbers, not texts.
2. Anchors. The anchor of a string is the place of its least ``GRAM``-byte
   gram by hash, the first of equals. It depends on the string alone, so two
   equal strings have equal anchors at equal offsets, and the strings of one
   anchor are a run of neighbouring places: one stretch of at most
   ``2 * LENGTH - GRAM`` bytes holds them all. Each slice sends the hashes of
   its anchors, each one once, in packed blocks dealt out by hash range.
3. Candidates. Hashes of two slices, or of two documents of one slice, go
   back to their slices; strings of any other anchor stand in one document.
4. Stretches. Each slice sends the stretches of the candidate anchors, equal
   ones once with their least ``doc_id``, dealt out by anchor.
5. Deep-shallow sorting, for all anchors of a batch at once: the suffixes
   are sorted by multikey quicksort (ternary splits around a pivot character
   of eight bytes) down to ``SHALLOW`` bytes; groups that still share them go
   through a blind trie, which stores only the places where its suffixes
   part: a suffix walks down blindly, is compared once with the leaf that it
   reaches, and branches off where the two part. Suffixes that share
   ``LENGTH`` bytes are one class; the members in documents after the
   class's least one are marked.
6. Marks go back to the slices, which cover and cut the bytes.

Skew: a group of copies of a document is sorted once. A passage that stands in
millions of documents is one row for each slice, whatever their number. An anchor that many unlike stretches share
(a frequent word pair) is told from the slices' counts of unlike stretches: over
``heavy`` of them, its strings are dealt out one by one, by their own hash.
A document longer than a slice is a slice of its own, hashed a block at a
time. ``slice_bytes`` and ``block_bytes`` (text whose anchors meet in one task) set
the memory of a task; the number of packed blocks is (text / slice) x (text / block),
so both should grow with the memory that a task has.

Defined cases: a null text counts as empty. Null ``doc_id`` come after all
others; rows with one ``doc_id`` do not remove from each other. Documents
under ``LENGTH`` bytes keep all of them. An empty table gives an empty result.
Extra columns are not read, whatever their names. Slices are named by
partition and number and written under a name of the attempt first, so a
task that runs again writes the same files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.shared import open_shared, shared_path, text_or_empty, write_shared

LENGTH = 50
GRAM = 20
SHALLOW = 24
SLICE_BYTES = 4 << 20
BLOCK = 1 << 18
LAST = (1 << 63) - 1
HASH_BYTES = 6  # of an anchor's 64 bits, the leading ones are sent
_ODD = 0x9E3779B97F4A7C15


# -- deep-shallow sorting ------------------------------------------------------------

def _character(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from ``depth`` on of each suffix as one big-endian number."""
    rows = np.lib.stride_tricks.sliding_window_view(text, 8)[at + depth]
    return np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)


def multikey_quicksort(text: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes ``at`` of each group by their first ``depth`` bytes.

    ``group`` is ascending. Returns (order, group of each place in it): suffixes
    that share all ``depth`` bytes are one group. Every round splits all
    open groups by a pivot each, into less, equal and greater; equal ones go
    on to the next character.
    """
    order, label = np.arange(len(at)), np.unique(group, return_inverse=True)[1].astype(np.int64)
    level = np.zeros(len(at), np.int64)  # characters that a place's group shares
    last = -(-depth // 8)
    while True:
        starts = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
        sizes = np.diff(np.append(starts, len(label)))
        open_ = np.repeat((sizes > 1) & (level[starts] < last), sizes)
        if not open_.any():
            return order, label
        here = np.flatnonzero(open_)
        own, lv = order[here], level[here]
        key = np.zeros(len(here), np.uint64)
        for v in np.unique(lv):
            of = lv == v
            key[of] = _character(text, at[own[of]], int(v) * 8)
        # pivot: the middle member's character
        cut = np.flatnonzero(np.concatenate(([True], label[here][1:] != label[here][:-1])))
        size = np.diff(np.append(cut, len(here)))
        pivot = np.repeat(key[cut + size // 2], size)
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        rank = np.repeat(np.arange(len(cut)), size) * 3 + side
        new = np.argsort(rank, kind="stable")
        order[here] = own[new]
        level[here] = (lv + (side == 1))[new]
        # number the groups anew, in order
        mark = np.zeros(len(label), bool)
        mark[starts] = True
        mark[here] |= np.concatenate(([True], rank[new][1:] != rank[new][:-1]))
        label = np.cumsum(mark) - 1


class BlindTrie:
    """Strings of one length by the places where they part. A node is
    [depth, children by byte, any leaf below]; a leaf is [string, members]."""

    def __init__(self):
        self.root = None

    def add(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = [string, [member]]
            return
        node = self.root
        while len(node) == 3:  # blindly: only the bytes where others part are looked at
            node = node[1].get(string[node[0]], node[2])
        if node[0] == string:
            node[1].append(member)
            return
        parts = next(i for i, (a, b) in enumerate(zip(node[0], string)) if a != b)
        leaf, other = [string, [member]], node[0][parts]
        parent, now = None, self.root
        while len(now) == 3 and now[0] < parts:
            parent, now = now, now[1][string[now[0]]]
        if len(now) == 3 and now[0] == parts:
            now[1][string[parts]] = leaf
            return
        branch = [parts, {other: now, string[parts]: leaf}, now if len(now) == 2 else now[2]]
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch

    def leaves(self) -> Iterator[list]:
        """[string, members] in the order of the strings."""
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if len(node) == 2:
                yield node
            else:
                todo += [node[1][b] for b in sorted(node[1], reverse=True)]


def suffix_classes(text: np.ndarray, at: np.ndarray, group: np.ndarray, length: int = LENGTH,
                   shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, class) of the suffixes ``at`` (``text`` goes on for ``length``
    bytes and eight more after each): sorted within their group; suffixes of a group that
    share ``length`` bytes are one class."""
    shallow = min(shallow, length // 8 * 8)
    order, label = multikey_quicksort(text, at, group, shallow)
    starts = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
    sizes = np.diff(np.append(starts, len(label)))
    mark = np.zeros(len(label), bool)
    mark[starts] = True
    if shallow < length:
        data = text.tobytes()
        places = at.tolist()
        for lo, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            trie = BlindTrie()
            for m in order[lo:lo + n].tolist():
                p = places[m]
                trie.add(data[p + shallow:p + length], m)
            k = lo
            for _, members in trie.leaves():
                mark[k] = True
                order[k:k + len(members)] = members
                k += len(members)
    return order, np.cumsum(mark) - 1


# -- anchors -------------------------------------------------------------------------

def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at every place."""
    h, n = text.astype(np.uint64) + np.uint64(1), 1
    out, done, places = None, 0, len(text) - gram + 1
    while True:  # a polynomial over the bytes, from pieces of doubling lengths
        if gram & n:
            own = h[done:done + places]
            out = own.copy() if out is None else out * np.uint64(pow(_ODD, n, 1 << 64)) + own
            done += n
        if done == gram:
            return _mixed(out)
        h = h[:-n] * np.uint64(pow(_ODD, n, 1 << 64)) + h[n:]
        n *= 2


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while n * 2 <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[:len(x) - (width - n)], x[width - n:]) if n < width else x


def anchors_of(text: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM,
               block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, anchor, first, last, ends) of the runs of places whose strings
    have one anchor; ``ends`` is a hash of the first and last grams of
    the run's stretch. ``starts`` are the documents' first places and the end
    of the last one. No string crosses documents."""
    out = []
    doc_of_end = starts[1:]
    for at in range(0, max(0, len(text) - length + 1), block):
        end = min(len(text), at + block + length - 1)
        part = text[at:end]
        h = gram_hashes(part, gram)
        key = (h & np.uint64(~((1 << 21) - 1) & ((1 << 64) - 1))) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_least(key, length - gram + 1)
        where = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        place = np.arange(len(where))
        room = doc_of_end[np.searchsorted(doc_of_end, at + place, "right").clip(0, len(doc_of_end) - 1)] - (at + place)
        fits = room >= length
        first = fits & np.concatenate(([True], (where[1:] != where[:-1]) | ~fits[:-1]))
        last = fits & np.concatenate(((where[1:] != where[:-1]) | ~fits[1:], [True]))
        f, e = np.flatnonzero(first), np.flatnonzero(last)
        # least hashes are small ones: mixed once more, they spread over all ranges
        out.append((_mixed(h[where[f]] + np.uint64(_ODD)), at + where[f], at + f, at + e,
                    h[f] * np.uint64(_ODD) + h[e + length - gram]))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out))


# -- slices ----------------------------------------------------------------------------

def slice_name(number: int) -> str:
    return f"slice-{number:016x}.arrow"


class Slice:
    """The documents of one packed file."""

    def __init__(self, folder: str, number: int):
        import pyarrow as pa

        fs, at = open_shared(f"{folder}/{slice_name(number)}")
        with fs.open_input_file(at) as f:
            rows = pa.ipc.open_file(pa.py_buffer(f.read())).read_all().combine_chunks()
        self.doc_id = rows.column("doc_id").combine_chunks()
        text = rows.column("text").combine_chunks()
        self.starts = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
        self.text = np.frombuffer(text.buffers()[2] or b"", np.uint8)[self.starts[0]:self.starts[-1]]
        self.starts = self.starts - self.starts[0]
        self.rank = self.doc_id.fill_null(LAST).to_numpy()

    def runs(self, gram: int, length: int, copies: np.ndarray):
        """Anchors with their document; none of the later ``copies``."""
        h, anchor, first, last, ends = anchors_of(self.text, self.starts, length, gram)
        doc = np.searchsorted(self.starts, first, "right") - 1
        if len(copies):
            copy = np.zeros(len(self.rank), bool)
            copy[copies] = True
            keep = ~copy[doc]
            return h[keep], anchor[keep], first[keep], last[keep], ends[keep], doc[keep]
        return h, anchor, first, last, ends, doc


def pack(docs: DataFrame, folder: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Write the documents in slices below ``folder``; returns (slice, bytes,
    digests, ranks) of each, packed in the documents' order."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, base = open_shared(folder)
        fs.create_dir(base, recursive=True)
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_binary())])
        held, size, number = [], 0, 0

        def write():
            nonlocal held, size, number
            own = (task.partitionId() << 32) + number
            name = slice_name(own)
            attempt = f"{base}/_attempt-{task.taskAttemptId()}-{name}"
            table = pa.Table.from_batches(held).cast(schema).combine_chunks()
            with fs.open_output_stream(attempt, compression=None) as out, \
                    pa.ipc.new_file(out, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(table)
            fs.move(attempt, f"{base}/{name}")
            digests = b"".join(hashlib.sha256(memoryview(t.as_buffer())).digest() for t in table.column("text"))
            ranks = table.column("doc_id").combine_chunks().fill_null(LAST).to_numpy().tobytes()
            row = pa.RecordBatch.from_pydict({"slice": [own], "bytes": [size], "digests": [digests], "ranks": [ranks]})
            held, size, number = [], 0, number + 1
            return row

        for b in batches:
            lo = 0
            for i, n in enumerate(pc.binary_length(b.column(1)).to_pylist()):
                if size and size + n > slice_bytes:
                    if i > lo:
                        held.append(b.slice(lo, i - lo))
                        lo = i
                    yield write()
                size += n
            if b.num_rows > lo:
                held.append(b.slice(lo))
        if held:
            yield write()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, "slice long, bytes long, digests binary, ranks binary")


def later_copies(slices: DataFrame) -> DataFrame:
    """(slice, copies): the numbers of the documents in each slice that equal,
    as a whole, one with a smaller ``doc_id``. A group of copies is one row for each slice."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for number, digests, ranks in zip(*(c.to_pylist() for c in b.columns)):
                groups: dict = {}
                for i, rank in enumerate(np.frombuffer(ranks, np.int64).tolist()):
                    groups.setdefault(digests[i * 32:i * 32 + 32], []).append({"number": i, "rank": rank})
                docs = pa.array(list(groups.values()), pa.list_(pa.struct([("number", pa.int32()), ("rank", pa.int64())])))
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(groups), pa.int64()), pa.array(list(groups), pa.binary()), docs],
                                                 ["slice", "digest", "docs"])

    schema = "slice long, digest binary, docs array<struct<number:int,rank:long>>"
    groups = slices.select("slice", "digests", "ranks").mapInArrow(run, schema)
    ranks = groups.select("digest", F.array_min("docs.rank").alias("least"), F.array_max("docs.rank").alias("most"))
    least = ranks.groupBy("digest").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("most > least").drop("most")
    late = groups.join(least, "digest").select("slice", F.expr("filter(docs, d -> d.rank > least).number").alias("numbers"))
    return late.groupBy("slice").agg(F.flatten(F.collect_list("numbers")).alias("copies"))


def _copies(table) -> np.ndarray:
    """The numbers of the later copies in a slice's rows."""
    return np.array([n for c in table.column("copies").to_pylist() if c is not None for n in c], np.int64)


def _cut(h: np.ndarray) -> bytes:
    """The leading HASH_BYTES of each hash."""
    return h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def _uncut(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BYTES)
    return out.view(">u8").ravel().astype(np.uint64)


_LOW = np.uint64((1 << (64 - 8 * HASH_BYTES)) - 1)


def anchor_blocks(slices: DataFrame, folder: str, bits: int, gram: int, length: int) -> DataFrame:
    """(block, slice, hashes, twice, unlike): the different anchors of each
    slice by their leading ``bits``; ``twice``: which ones stand in two
    documents; ``unlike``: how many unlike stretches have it, 255 at most."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for number, copies in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = Slice(folder, number)
                h, _, _, _, ends, doc = s.runs(gram, length, np.array(copies or [], np.int64))
                if not len(h):
                    continue
                h = h & ~_LOW
                order = np.lexsort((ends, h))
                h, ends, rank = h[order], ends[order], s.rank[doc][order]
                other = np.concatenate(([True], h[1:] != h[:-1]))
                first = np.flatnonzero(other)
                twice = np.minimum.reduceat(rank, first) < np.maximum.reduceat(rank, first)
                unlike = np.add.reduceat((other | np.concatenate(([True], ends[1:] != ends[:-1]))).astype(np.int64), first)
                h, unlike = h[first], np.minimum(unlike, 255).astype(np.uint8)
                block = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
                parts = list(zip(cut, np.append(cut[1:], len(h))))
                yield pa.RecordBatch.from_arrays([
                    pa.array(block[cut]), pa.array([number] * len(cut), pa.int64()),
                    pa.array([_cut(h[i:j]) for i, j in parts], pa.binary()), pa.array([np.packbits(twice[i:j]).tobytes() for i, j in parts], pa.binary()),
                    pa.array([unlike[i:j].tobytes() for i, j in parts], pa.binary())], ["block", "slice", "hashes", "twice", "unlike"])

    return slices.mapInArrow(run, "block long, slice long, hashes binary, twice binary, unlike binary")


def candidates(blocks: DataFrame, heavy: int) -> DataFrame:
    """(slice, hashes, many): the hashes of two slices or two documents, for
    each slice that has them; ``many``: which ones have over ``heavy`` stretches that are unlike in a slice."""
    def run(table):
        import pyarrow as pa

        names = table.column("slice").to_pylist()
        own = [_uncut(x) for x in table.column("hashes").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(h)).astype(bool) for t, h in zip(table.column("twice").to_pylist(), own)]
        count = np.concatenate([np.frombuffer(u, np.uint8) for u in table.column("unlike").to_pylist()])
        h, t, of = np.concatenate(own), np.concatenate(twice), np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        size = np.diff(np.append(first, len(h)))
        common = (size > 1) | (np.maximum.reduceat(t[order].astype(np.int8), first) > 0)
        keep = np.repeat(common, size)
        h, of, many = h[order][keep], of[order][keep], np.repeat(np.add.reduceat(count[order].astype(np.int64), first) > heavy, size)[keep]
        order = np.argsort(of, kind="stable")  # hashes stay ascending within a slice
        h, of, many = h[order], of[order], many[order]
        cut = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
        stop = np.append(cut[1:], len(of))
        return pa.Table.from_arrays([
            pa.array([names[of[i]] for i in cut], pa.int64()), pa.array([_cut(h[i:j]) for i, j in zip(cut, stop)], pa.binary()),
            pa.array([np.packbits(many[i:j]).tobytes() for i, j in zip(cut, stop)], pa.binary())], ["slice", "hashes", "many"])

    return blocks.groupBy("block").applyInArrow(run, "slice long, hashes binary, many binary")


STRETCHES = "deal long, reach int, stretch binary, least long, slice long, number int"


class Stretches:
    """The candidate runs of a slice: equal stretches once, in a fixed order,
    so that they have the same numbers whenever they are listed."""

    def __init__(self, s: Slice, hashes: np.ndarray, many: np.ndarray, copies: np.ndarray, gram: int, length: int):
        h, anchor, first, last, _, doc = s.runs(gram, length, copies)
        place = np.searchsorted(hashes, h & ~_LOW).clip(0, max(0, len(hashes) - 1))
        hit = hashes[place] == (h & ~_LOW) if len(hashes) else np.zeros(len(h), bool)
        h, anchor, first, last, doc = h[hit], anchor[hit], first[hit], last[hit], doc[hit]
        split = many[place[hit]]
        if split.any():  # each string of a frequent anchor on its own
            n = np.where(split, last - first + 1, 1)
            which = np.repeat(np.arange(len(h)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            alone = split[which]
            h, anchor, doc = h[which], anchor[which], doc[which]
            first, last = first[which] + step, np.where(alone, first[which] + step, last[which])
        else:
            alone = split
        data = s.text.tobytes()
        self.known: dict = {}
        self.number = np.zeros(len(h), np.int64)
        self.least: list = []
        rank = s.rank[doc].tolist()
        for i, (a, off, f, e, x) in enumerate(zip(h.tolist(), (anchor - first).tolist(), first.tolist(), last.tolist(), alone.tolist())):
            key = (a, off, x, data[f:e + length])
            n = self.known.setdefault(key, len(self.known))
            if n == len(self.least):
                self.least.append(rank[i])
            elif rank[i] < self.least[n]:
                self.least[n] = rank[i]
            self.number[i] = n
        self.first, self.last, self.rank = first, last, s.rank[doc]


def _listed(table) -> tuple[np.ndarray, np.ndarray]:
    """The candidate hashes of a slice from its blocks, ascending."""
    own = [_uncut(x) for x in table.column("hashes").to_pylist() if x is not None]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(h)).astype(bool)
            for m, h in zip((m for m in table.column("many").to_pylist() if m is not None), own)]
    if not own:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h, m = np.concatenate(own), np.concatenate(many)
    order = np.argsort(h)
    return h[order], m[order]


def stretches(found: DataFrame, folder: str, gram: int, length: int) -> DataFrame:
    """The stretches of each slice's candidates."""
    def run(table):
        import pyarrow as pa
        import xxhash

        number = table.column("slice")[0].as_py()
        own = Stretches(Slice(folder, number), *_listed(table), _copies(table), gram, length)
        deal, reach, bytes_ = [], [], []
        for a, off, alone, text in own.known:
            d = xxhash.xxh64_intdigest(text, off) if alone else a
            deal.append(d - (1 << 64) if d >= 1 << 63 else d)
            reach.append(off)
            bytes_.append(text)
        return pa.Table.from_arrays([
            pa.array(deal, pa.int64()), pa.array(reach, pa.int32()), pa.array(bytes_, pa.binary()), pa.array(own.least, pa.int64()),
            pa.array([number] * len(deal), pa.int64()), pa.array(range(len(deal)), pa.int32())], [f.split()[0] for f in STRETCHES.split(", ")])

    return found.groupBy("slice").applyInArrow(run, STRETCHES)


def _marks(deal: np.ndarray, reach: np.ndarray, texts: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For whole groups of equal ``deal``: (marks, least document) of each row.
    Bit i of the marks: the row's least document loses the string that starts i bytes into the stretch."""
    # equal stretches once, with the least document
    known: dict = {}
    which = np.fromiter((known.setdefault(k, len(known)) for k in zip(deal.tolist(), reach.tolist(), texts)), np.int64, len(texts))
    first = np.full(len(known), LAST, np.int64)
    np.minimum.at(first, which, least)
    keys = list(known)
    group = np.array([k[0] for k in keys], np.int64)
    sizes = np.unique(group, return_inverse=True)[1]
    several = np.bincount(sizes)[sizes] > 1
    own_mark = np.zeros(len(keys), np.int64)
    at = np.flatnonzero(several)
    if len(at):
        parts = [keys[i][2] for i in at]
        text = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
        n = np.array([len(p) for p in parts])
        begin = np.cumsum(n) - n
        strings = n - length + 1
        of = np.repeat(np.arange(len(at)), strings)
        step = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
        # strings of one anchor at one distance before it
        before = np.array([keys[i][1] for i in at])[of] - step
        bucket = np.unique(sizes[at][of] * (2 * length) + before + length, return_inverse=True)[1]
        order = np.argsort(bucket, kind="stable")
        places, of, step = (begin[of] + step)[order], of[order], step[order]
        sorted_, label = suffix_classes(text, places, bucket[order], length)
        start = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
        owner = first[at][of[sorted_]]
        low = np.repeat(np.minimum.reduceat(owner, start), np.diff(np.append(start, len(label))))
        late = owner > low
        np.bitwise_or.at(own_mark, at[of[sorted_[late]]], np.int64(1) << step[sorted_[late]])
    strings = np.array([len(k[2]) - length + 1 for k in keys], np.int64)
    whole = (np.int64(1) << strings) - 1
    return np.where(least > first[which], whole[which], own_mark[which]), first[which]


def sort_suffixes(dealt: DataFrame, length: int, batch_bytes: int = 2 << 20) -> DataFrame:
    """(slice, number, marks, least) of every stretch; ``least`` is the least
    document of all slices with the whole stretch. Without marks a slice needs no reply:
    that its later documents lose what its least one has, it knows itself."""
    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def done(table):
            deal = table.column("deal").to_numpy()
            marks, least = _marks(deal, table.column("reach").to_numpy(), table.column("stretch").to_pylist(), table.column("least").to_numpy(), length)
            return pa.RecordBatch.from_arrays([table.column("slice").combine_chunks(), table.column("number").combine_chunks(), pa.array(marks),
                                               pa.array(least)], ["slice", "number", "marks", "least"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.column(2).nbytes
            if size < batch_bytes:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            deal = table.column("deal").to_numpy()
            end = int(np.searchsorted(deal, deal[-1]))  # the last anchor may go on
            if end:
                yield done(table.slice(0, end))
            held = table.slice(end).to_batches()
            size = sum(x.column(2).nbytes for x in held) if end else 0
        if held:
            yield done(pa.Table.from_batches(held))

    rows = dealt.repartition("deal").sortWithinPartitions("deal")
    return rows.mapInArrow(run, "slice long, number int, marks long, least long")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(s: Slice, table, gram: int, length: int) -> np.ndarray:
    """Which bytes of the slice go."""
    step = np.zeros(len(s.text) + 1, np.int32)
    hashes, many = _listed(table)
    copies = _copies(table)
    sizes = np.diff(s.starts)
    for i in copies[sizes[copies] >= length].tolist():  # wholly in a document with a smaller id
        step[s.starts[i]] += 1
        step[s.starts[i + 1]] -= 1
    if len(hashes):
        own = Stretches(s, hashes, many, copies, gram, length)
        marks = np.zeros(len(own.known), np.int64)
        least = np.array(own.least, np.int64)
        for c in table.select(["numbers", "marks", "leasts"]).to_pylist():
            if c["numbers"] is not None:
                at = np.array(c["numbers"], np.int64)
                marks[at], least[at] = c["marks"], c["leasts"]
        # the first document with a stretch loses what its marks say, later ones all of it
        whole = (np.int64(1) << (own.last - own.first + 1)) - 1
        lost = np.where(own.rank > least[own.number], whole, marks[own.number])
        for bit in range(length - gram + 1):
            at = own.first[(lost >> bit) & 1 == 1] + bit
            np.add.at(step, at, 1)
            np.add.at(step, at + length, -1)
    return np.cumsum(step[:-1]) > 0


def cut_slices(replies: DataFrame, folder: str, gram: int, length: int, with_bytes: bool) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: what is left (null without ``with_bytes``)."""
    def run(table):
        import pyarrow as pa

        s = Slice(folder, table.column("slice")[0].as_py())
        gone = _covered(s, table, gram, length)
        out = []
        for i, doc_id in enumerate(s.doc_id.to_pylist()):
            lo, hi = s.starts[i], s.starts[i + 1]
            own = gone[lo:hi]
            n = int(own.sum())
            spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()) if n else 0
            left = s.text[lo:hi][~own].tobytes() if n else s.text[lo:hi].tobytes()
            out.append((doc_id, int(hi - lo), n, spans, hashlib.sha256(left).hexdigest(), left if with_bytes else None))
        names = [f.split()[0] for f in RESULT.split(", ")] + ["kept"]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return replies.groupBy("slice").applyInArrow(run, RESULT + ", kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, slice_bytes: int = SLICE_BYTES,
                   block_bytes: int = 16 << 20, heavy: int = 1024, with_bytes: bool = True) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and ``kept``, the bytes that are left. ``length - gram`` is 62 at most."""
    spark = docs.sparkSession
    folder = shared_path(spark, "slices")
    slices = write_shared(pack(docs, folder, slice_bytes), "slice-list")
    count, total = slices.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if not count:
        return spark.createDataFrame([], RESULT + ", kept binary")
    tasks = int(count)  # a slice each, whatever the size of the rows that tell of it
    slices = write_shared(slices.select("slice").join(later_copies(slices), "slice", "left"), "slice-copies")
    # the blocks of a range of hashes meet in one task, some megabytes of them
    bits = max(0, (-(-total // block_bytes) - 1).bit_length())
    found = write_shared(candidates(anchor_blocks(slices.repartition(tasks), folder, bits, gram, length), heavy), "anchors")
    listed = found.unionByName(slices, allowMissingColumns=True).repartition(tasks, "slice")
    sorted_ = sort_suffixes(stretches(listed, folder, gram, length), length).where("marks <> 0")
    replies = sorted_.groupBy("slice", F.spark_partition_id().alias("task")).agg(
        F.collect_list(F.struct("number", "marks", "least")).alias("c"))
    replies = replies.select("slice", F.col("c.number").alias("numbers"), F.col("c.marks").alias("marks"), F.col("c.least").alias("leasts"))
    every = slices.unionByName(found, allowMissingColumns=True).unionByName(replies, allowMissingColumns=True)
    return cut_slices(every.repartition(tasks, "slice"), folder, gram, length, with_bytes)


def repeat_report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs, with_bytes=False, **params).drop("kept")
