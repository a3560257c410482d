"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The merge ranks are small integers, so the queue is an array of buckets, one
for each rank, and a bitmap of the buckets that are not empty, with a summary
bitmap above it: a set bit of the summary stands for a word of the bitmap
that is not zero. Find-first-set on the summary and on the word it names
gives the lowest rank. A bucket holds positions of a linked list of parts;
a position whose pair has changed since is stale and skipped. A pre-token of
n bytes takes n log n steps at most, whatever its length.

A text is cut into pre-tokens by the pattern. Where all its white space is
single blanks and line ends, no pre-token reaches over a blank (it can only
begin with one), so the text is cut there and each different piece is encoded
once per worker; other texts are cut by the pattern as a whole.

Defined cases: a null text counts as empty and has no ids. Repeated rows each
give a row; an empty table gives an empty result; extra columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from heapq import heappop, heappush

import numpy as np
from pyspark.sql import DataFrame

from forgeline.llm.shared import text_or_empty

#: bits of a word of the rank bitmap, as a power of two (Python integers: a word of any width is one object)
WORD_BITS = 8
#: pieces that a worker remembers
REMEMBERED = 900_000
LONG_PIECE = 64
#: below this code point every Unicode version agrees on what is a letter
LATIN_END = "\u0250"
#: signs that never join the letters before them (the apostrophe may)
SIGNS = ".,;:!?#$%&*|<>()[]{}@/+=~^\"-_"


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: again and again the pair of lowest rank is
    joined, the leftmost of equal ones first."""
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n == 2:
        return [ranks[piece[:1]], ranks[piece[1:]]]
    end = list(range(1, n + 1))  # the part that starts at i ends at end[i]
    before = list(range(-1, n - 1))  # and the one before it starts at before[i]
    pair = [get(piece[i:i + 2], -1) for i in range(n)]  # rank of the part at i with the next one
    pair[n - 1] = -1
    summary, words, buckets = 0, {}, {}
    low_bits = (1 << WORD_BITS) - 1
    for i, rank in enumerate(pair):
        if rank >= 0:
            if rank in buckets:
                buckets[rank].append(i)  # ascending: a heap
            else:
                buckets[rank] = [i]
                word = rank >> WORD_BITS
                words[word] = words.get(word, 0) | 1 << (rank & low_bits)
                summary |= 1 << word
    while summary:
        # find first set: the lowest word that is not empty, then its lowest bit
        word = (summary & -summary).bit_length() - 1
        bits = words[word]
        first = bits & -bits
        rank = (word << WORD_BITS) + first.bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) == 1:
            i = bucket[0]
            del buckets[rank]
            words[word] = bits = bits ^ first
            if not bits:
                summary ^= 1 << word
        else:
            i = heappop(bucket)
        if pair[i] != rank:
            continue  # stale: the pair has changed since
        j = end[i]  # the part that is joined to i
        stop = end[j]
        end[i], pair[j], pair[i] = stop, -1, -1
        # the joined part makes new pairs with the next one and the one before it
        if stop < n:
            before[stop] = i
            rank = get(piece[i:end[stop]])
            if rank is not None:
                pair[i] = rank
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    word = rank >> WORD_BITS
                    words[word] = words.get(word, 0) | 1 << (rank & low_bits)
                    summary |= 1 << word
        k = before[i]
        if k >= 0:
            rank = get(piece[k:stop])
            if rank is None:
                pair[k] = -1
            else:
                pair[k] = rank
                if rank in buckets:
                    heappush(buckets[rank], k)
                else:
                    buckets[rank] = [k]
                    word = rank >> WORD_BITS
                    words[word] = words.get(word, 0) | 1 << (rank & low_bits)
                    summary |= 1 << word
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class _Known(dict):
    """Ids (as bytes of int32) by piece; an unknown piece is encoded when it
    is asked for. ``lead`` is put before it."""

    def __init__(self, codec: Codec, lead: str):
        self.codec, self.lead = codec, lead

    def __missing__(self, piece: str) -> bytes:
        ids = self.codec.encode_piece(self.lead, piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= self.codec.remembered:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import base64

        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.names = {rank: str(rank) for rank in self.bytes_of}
        self.cut = regex.compile(pattern).findall
        # whether the pattern leaves a run of letters whole, whatever their case
        self.letter_runs = all(self.cut(run) == [run] for run in ("aBc", "Abc", "ABc", " aBc", " Abc", " ABc"))
        self.remembered = remembered
        self.after_blank, self.bare = _Known(self, " "), _Known(self, "")

    def encode_piece(self, lead: str, piece: str) -> bytes:
        """Ids of a piece without white space (but a ``lead`` blank), or of a whole text."""
        letters = piece.rstrip(SIGNS)
        if letters and letters.isalpha() and max(letters) < LATIN_END:
            if letters != piece:
                # letters and signs are pre-tokens of their own, and each is known more often
                return (self.after_blank if lead else self.bare)[letters] + self.bare[piece[len(letters):]]
            if self.letter_runs:
                return array("i", merge((lead + piece).encode(), self.ranks)).tobytes()
        ids = []
        for token in self.cut(lead + piece):
            ids += merge(token.encode(), self.ranks)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(encoded_parts(text, self.bare, self.after_blank)), np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encoded_parts(text: str, bare, after_blank) -> list[bytes]:
    """Looks up the pieces of a text, in order: words after a blank in
    ``after_blank``, all else in ``bare``. Cut is only where no pre-token can
    reach over: before single blanks and around single line ends. A text with
    other white space, or with two white characters in a row, is one piece."""
    blank = text.replace("\n", " ")
    if " ".join(blank.split()) != blank:
        return [bare[text]]
    out = []
    if text:
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if i:
                out.append(bare["\n"])
            out.append(bare[words[0]])
            out.extend(map(after_blank.__getitem__, words[1:]))
    return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec; it keeps what it remembers from task to task."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, check: bool = False) -> DataFrame:
    """doc_id, ids (array of int) for each row of ``docs``; with ``check``
    the ids are decoded again and must give the text's bytes."""
    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = part.column(1).to_pylist()
                ids = [own.encode(t) for t in texts]
                if check and any(own.decode(i.tolist()) != t.encode() for i, t in zip(ids, texts)):
                    raise ValueError("decoded bytes differ from the text")
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int64).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary) for each row (doc_id, ids)."""
    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for b in batches:
            data = [own.decode(ids) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests of encoding
    and decoding each row, made in one pass so that ids of all documents need
    not be kept."""
    def run(batches):
        import pyarrow as pa

        own = codec(path, pattern)
        for b in batches:
            sizes, of_ids, of_bytes = [], [], []
            for value in b.column(1):
                ids = own.encode(value.as_py()).tolist()
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(own.names.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
