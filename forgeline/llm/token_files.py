"""Token-id files: independent zstandard frames with a trailing seek table.

A file holds the ids of consecutive documents (little-endian, 32 bits) as one
stream, cut every ``FRAME_IDS`` ids into zstandard frames that need nothing
of each other. The next frame is the document index (ids of the documents,
which of them are null, numbers of tokens), and the file ends with a seek
table in the layout of the zstandard seekable format: a skippable frame with
the packed size, plain size and checksum (low 32 bits of XXH64) of each
frame. Any zstandard tool can unpack such a file. A reader takes the seek
table and the index, and then unpacks only the frames in which a requested
document lies.

Files are written by the tasks that own a range of ``doc_id``, in ascending
order, under a name of the attempt, and take their final name when complete:
a task that runs again writes the same bytes.

Defined cases: a null text counts as empty; each document ends with
``end_id``, so an empty one has one token. Null ``doc_id`` come first; rows
with one ``doc_id`` are ordered by the hash of their text. An empty table
gives no files and an empty result. Extra columns are not read, whatever
their names. A document longer than a frame lies in several frames.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.bpe import LATIN_END, LONG_PIECE, SIGNS, encoded_parts
from forgeline.llm.shared import open_shared, shared_path, text_or_empty, write_shared

FRAME_IDS = 1 << 16
#: pieces of each kind that a worker remembers, some tens of megabytes
REMEMBERED = 500_000
LEVEL = 3
# fixed values of the zstandard seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80


# -- the file format -----------------------------------------------------------

def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents one after the other to a binary stream."""

    def __init__(self, stream, frame_ids: int = FRAME_IDS):
        import zstandard

        self.stream, self.frame_bytes = stream, frame_ids * 4
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.table, self.open, self.open_bytes = [], [], 0
        self.ids, self.nulls, self.sizes = [], [], []

    def _frame(self, data: bytes) -> None:
        packed = self.pack(data)
        self.stream.write(packed)
        self.table.append((len(packed), len(data), _checksum(data)))

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(tokens) // 4)
        self.open.append(tokens)
        self.open_bytes += len(tokens)
        if self.open_bytes >= self.frame_bytes:
            data, at = b"".join(self.open), 0
            while len(data) - at >= self.frame_bytes:
                self._frame(data[at:at + self.frame_bytes])
                at += self.frame_bytes
            self.open, self.open_bytes = [data[at:]], len(data) - at

    def close(self) -> None:
        if self.open_bytes:
            self._frame(b"".join(self.open))
        self._frame(struct.pack("<QQ", len(self.ids), self.frame_bytes // 4) + np.array(self.ids, "<i8").tobytes()
                    + np.array(self.sizes, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes())
        body = b"".join(struct.pack("<III", *entry) for entry in self.table) + struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


class TokenFileReader:
    """Random access to the documents of one file (a seekable binary stream)."""

    def __init__(self, stream, size: int):
        import zstandard

        self.stream, self.unpack = stream, zstandard.ZstdDecompressor().decompress
        tail = self._read(size - 9, 9)
        frames, flags, magic = struct.unpack("<IBI", tail)
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        body = self._read(size - 9 - 12 * frames, 12 * frames)
        table = np.frombuffer(body, "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.plain, self.sums = table.T
        self.at = np.cumsum(self.packed) - self.packed
        self.frames_read = 0
        index = self.frame(frames - 1)
        n, self.frame_ids = struct.unpack_from("<QQ", index)
        self.ids = np.frombuffer(index, "<i8", n, 16)
        self.sizes = np.frombuffer(index, "<i8", n, 16 + 8 * n)
        self.nulls = np.frombuffer(index, np.uint8, n, 16 + 16 * n).astype(bool)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _read(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def frame(self, i: int) -> bytes:
        data = self.unpack(self._read(int(self.at[i]), int(self.packed[i])), max_output_size=int(self.plain[i]))
        if _checksum(data) != self.sums[i]:
            raise ValueError(f"frame {i} does not match its checksum")
        self.frames_read += 1
        return data

    def tokens(self, start: int, n: int) -> bytes:
        """``n`` ids from ``start`` on, from the frames they lie in alone."""
        first, last = start // self.frame_ids, (start + n - 1) // self.frame_ids
        data = b"".join(self.frame(i) for i in range(first, last + 1)) if n else b""
        skip = (start - first * self.frame_ids) * 4
        return data[skip:skip + n * 4]

    def documents(self, wanted) -> dict[int, np.ndarray]:
        """Ids of the wanted documents that are in this file."""
        places = np.flatnonzero(np.isin(self.ids, np.array(list(wanted), np.int64)) & ~self.nulls)
        return {int(self.ids[p]): np.frombuffer(self.tokens(int(self.starts[p]), int(self.sizes[p])), "<u4") for p in places}

    def digests(self):
        """(crc32, size) of every document, in order; one frame is held at a time."""
        data, frame, at = b"", -1, 0
        for n in self.sizes:
            crc, left = 0, int(n) * 4
            while left:
                if at == len(data):
                    frame += 1
                    data, at = self.frame(frame), 0
                take = min(left, len(data) - at)
                crc = zlib.crc32(data[at:at + take], crc)
                at, left = at + take, left - take
            yield crc, int(n)


# -- tokenizing ----------------------------------------------------------------

def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    itself where it is visible, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """Token bytes by piece; an unknown piece goes through the tokenizer once."""

    def __init__(self, owner: Tokens, lead: str):
        self.owner, self.lead = owner, lead

    def __missing__(self, piece: str) -> bytes:
        ids = self.owner.piece(self.lead, piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= self.owner.remembered:
                self.clear()
            self[piece] = ids
        return ids


class Tokens:
    """Texts to ids (bytes of little-endian 32-bit numbers) by a vocabulary
    file of the tokenizers library; equal pieces are encoded once. A text in which
    one of the vocabulary's added tokens stands goes through the library as a whole."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model, self.letters = self.whole.model, _byte_letters()
        self.blank = self.letters[ord(" ")]
        self.remembered = remembered
        self.after_blank, self.bare = _Known(self, " "), _Known(self, "")

    def piece(self, lead: str, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha() and len(piece) <= LONG_PIECE:  # one pre-token: the merges alone
            return array("I", [t.id for t in self.model.tokenize((self.blank if lead else "") + piece)]).tobytes()
        letters = piece.rstrip(SIGNS)
        if letters.isalpha() and max(letters) < LATIN_END:
            if letters != piece:  # letters and signs are pre-tokens of their own
                return (self.after_blank if lead else self.bare)[letters] + self.bare[piece[len(letters):]]
            if len(piece) <= LONG_PIECE:
                mapped = (lead + piece).encode().decode("latin-1").translate(self.letters)
                return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        found = self.whole.encode_batch_fast([lead + piece], add_special_tokens=False)
        return np.array(found[0].ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(encoded_parts(text, self.bare, self.after_blank))


_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """The worker's tokenizer; it keeps what it remembers from task to task."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


# -- Spark ---------------------------------------------------------------------

def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Tokenize ``docs`` into files below ``folder`` (a shared folder), in
    ascending ``doc_id`` order; returns the manifest: part, path, docs,
    tokens, bytes, for each file."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        own, end = tokens_of(vocabulary), np.array([end_id], "<u4").tobytes()
        task = TaskContext.get()
        fs, base = open_shared(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{task.partitionId():07d}.ids.zst"
        attempt = f"{base}/_attempt-{task.taskAttemptId()}-{name}"
        with fs.open_output_stream(attempt, compression=None) as out:
            writer = TokenFileWriter(out, frame_ids)
            for batch in itertools.chain([first], batches):
                for at in range(0, batch.num_rows, 256):  # so many texts at once are Python objects
                    for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                        writer.add(doc_id, own.encode(text) + end)
            writer.close()
        fs.move(attempt, f"{base}/{name}")
        size = fs.get_file_info(f"{base}/{name}").size
        row = {"part": [task.partitionId()], "path": [f"{folder}/{name}"], "docs": [len(writer.ids)], "tokens": [sum(writer.sizes)], "bytes": [size]}
        yield pa.RecordBatch.from_pydict(row)

    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    sorted_ = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return sorted_.mapInArrow(run, "part long, path string, docs long, tokens long, bytes long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of
    every document, read back from the files of a manifest."""
    # one row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("part", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, path, start in batch.to_pandas().itertuples(index=False):
                fs, at = open_shared(path)
                with fs.open_input_file(at) as stream:
                    file = TokenFileReader(stream, stream.size())
                    crcs = np.fromiter((crc for crc, _ in file.digests()), np.int64, len(file.ids))
                ids = pa.array(file.ids, pa.int64(), mask=file.nulls)
                yield pa.RecordBatch.from_arrays([ids, pa.array(start + file.starts), pa.array(file.sizes), pa.array(crcs)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return placed.repartitionByRange(files, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    folder = shared_path(docs.sparkSession, "token-files")
    return read_token_files(write_shared(write_token_files(docs, vocabulary, folder, end_id), "token-manifest"))


def fetch_documents(manifest: DataFrame, wanted: list[int]) -> DataFrame:
    """doc_id, ids of the wanted documents; each task unpacks only the frames they lie in."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = open_shared(path)
                with fs.open_input_file(at) as stream:
                    found = TokenFileReader(stream, stream.size()).documents(wanted)
                ids = pa.array([v.astype(np.int32) for v in found.values()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), ids], ["doc_id", "ids"])

    return manifest.select("path").mapInArrow(run, "doc_id long, ids array<int>")
