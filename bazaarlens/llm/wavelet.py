"""Token ids as wavelet matrices: one self-contained compressed file per shard.

A shard holds the ids of consecutive documents. Level by level, from the highest bit down, the file
keeps one bit of every id as a bit-plane; after each level the ids are stably parted, zeros before ones.
Access, counting and finding occurrences walk the planes with rank and select, which a count of ones per
block supports. Planes are compressed one by one, so that a reader can decompress only what it needs.

File: magic, header (little-endian unsigned 64-bit: version, ids, documents, levels, start), the lengths
of the parts that follow, then: documents' end offsets, zeros per level, counts per level, planes.
Files are rows of a table in shared storage (one row per shard, a binary column), so that they can be on
any store Spark writes to and a task that is run again replaces its own output only.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import shared_dir, written
from .common import arrow_map
from .pieces import PieceTable

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
# Ids of a shard at least before it is closed; a document is never cut.
SHARD_IDS = 4_000_000
_MAGIC = b"WVLT"
_HEAD = struct.Struct("<4s5Q")
# Pieces that a worker keeps, so that its memory stays bounded.
CACHED_PIECES = 900_000
# Pieces encoded as one text: the library's cost per call is shared by them.
_JOINED_PIECES = 50_000
# Texts looked up at once, if their bytes allow: the more, the more of their pieces repeat.
_BATCH_ROWS = 2_000
_BLOCK_BITS = 4096  # bits between two stored counts
# Ids parted at once, so that places and ids stay in a processor's cache; a multiple of 8.
_PARTED = 1 << 16
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def build(ids: np.ndarray, ends: np.ndarray, start: int, levels: int) -> bytes:
    """File of one shard. ``ends``: per document the number of ids up to its end; ``start``: ids before the shard in its partition."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    current = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    zeros, parts, counts = [], [], []
    for level in range(levels - 1, -1, -1):
        plane, current, below = _parted(current, level)
        parts.append(squeeze(plane.tobytes()))
        counts.append(_block_counts(plane))
        zeros.append(below)
    body = [
        squeeze(np.diff(ends, prepend=0).astype("<u8").tobytes()),
        np.array(zeros, dtype="<u8").tobytes(),
        squeeze(b"".join(counts)),
        *parts,
    ]
    sizes = np.array([len(b) for b in body], dtype="<u8").tobytes()
    return _HEAD.pack(_MAGIC, 1, len(ids), len(ends), levels, start) + sizes + b"".join(body)


def _parted(current: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A level's bit-plane, the ids stably parted by it, zeros before ones, and the number of zeros."""
    bit, planes = current.dtype.type(1 << level), [np.zeros(0, np.uint8)]
    parted, high = np.empty_like(current), np.empty_like(current)
    zeros = ones = 0
    for at in range(0, len(current), _PARTED):
        own = current[at : at + _PARTED]
        is_one = own & bit != 0
        planes.append(np.packbits(is_one, bitorder="little"))
        # Places, as picking by random bits is slow.
        low, up = np.flatnonzero(~is_one), np.flatnonzero(is_one)
        parted[zeros : zeros + len(low)] = own[low]
        high[ones : ones + len(up)] = own[up]
        zeros, ones = zeros + len(low), ones + len(up)
    parted[zeros:] = high[:ones]
    return np.concatenate(planes), parted, zeros


def _block_counts(plane: np.ndarray) -> bytes:
    """Ones before each block of a plane."""
    size = _BLOCK_BITS // 8
    padded = np.zeros(-(-len(plane) // size) * size, dtype=np.uint8)
    padded[: len(plane)] = plane
    each = _ONES[padded].reshape(-1, size).sum(axis=1, dtype=np.uint64)
    return np.concatenate([[0], np.cumsum(each)]).astype("<u8").tobytes()


class Shard:
    """Reader of a shard's file."""

    def __init__(self, data: bytes):
        magic, version, self.size, documents, self.levels, self.start = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a wavelet matrix file")
        sizes = np.frombuffer(data, "<u8", 3 + self.levels, _HEAD.size).tolist()
        at = _HEAD.size + 8 * len(sizes)
        parts = []
        for size in sizes:
            parts.append((at, size))
            at += size
        self._data, self._parts = data, parts
        self._planes: dict[int, np.ndarray] = {}
        self.ends = np.cumsum(np.frombuffer(self._unpacked(0), "<u8")).astype(np.int64)
        self.zeros = np.frombuffer(data, "<u8", self.levels, parts[1][0]).astype(np.int64)
        self._counts = np.frombuffer(self._unpacked(2), "<u8").astype(np.int64).reshape(self.levels, -1)

    def _unpacked(self, part: int) -> bytes:
        at, size = self._parts[part]
        return zstandard.ZstdDecompressor().decompress(self._data[at : at + size])

    def _plane(self, level: int) -> np.ndarray:
        """Bits of a level, packed; level 0 is the highest bit."""
        if level not in self._planes:
            self._planes[level] = np.frombuffer(self._unpacked(3 + level), np.uint8)
        return self._planes[level]

    def _rank(self, level: int, place: int) -> int:
        """Ones of a level before a place."""
        plane, block = self._plane(level), place // _BLOCK_BITS
        whole = _ONES[plane[block * _BLOCK_BITS // 8 : place // 8]].sum(dtype=np.int64)
        rest = int(plane[place // 8]) & ((1 << place % 8) - 1) if place % 8 else 0
        return int(self._counts[level, block] + whole) + int(_ONES[rest])

    def _select(self, level: int, bit: int, nth: int) -> int:
        """Place of the nth (from 0) one or zero of a level."""
        ones = self._counts[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * _BLOCK_BITS, self.size) - ones
        block = int(np.searchsorted(before, nth, side="right")) - 1
        plane = self._plane(level)[block * _BLOCK_BITS // 8 : (block + 1) * _BLOCK_BITS // 8]
        bits = np.unpackbits(plane, bitorder="little")
        return block * _BLOCK_BITS + int(np.flatnonzero(bits == bit)[nth - int(before[block])])

    def _bit(self, token: int, level: int) -> int:
        return token >> (self.levels - 1 - level) & 1

    def access(self, place: int) -> int:
        """Token id at a place."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        token = 0
        for level in range(self.levels):
            bit = int(self._plane(level)[place // 8]) >> place % 8 & 1
            ones = self._rank(level, place)
            place = int(self.zeros[level]) + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """The last level's range that holds the occurrences of a token between two places."""
        if not 0 <= token < 1 << self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._rank(level, start), self._rank(level, end)
            if self._bit(token, level):
                start, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token between two places."""
        first, last = self._range(token, start, self.size if end is None else end)
        return last - first

    def find(self, token: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of a token."""
        first, last = self._range(token, 0, self.size)
        if not 0 <= nth < last - first:
            raise IndexError(nth)
        place = first + nth
        for level in range(self.levels - 1, -1, -1):
            bit = self._bit(token, level)
            place = self._select(level, bit, place - int(self.zeros[level]) if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """All ids in order: levels are undone from the last to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        values = np.zeros(self.size, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            plane, bit = self._plane(level), kind(1 << (self.levels - 1 - level))
            before = np.empty_like(values)
            zero, one = 0, int(self.zeros[level])
            for at in range(0, self.size, _PARTED):
                own = before[at : at + _PARTED]
                is_one = np.unpackbits(plane[at // 8 : (at + _PARTED) // 8], count=len(own), bitorder="little").view(bool)
                low, up = np.flatnonzero(~is_one), np.flatnonzero(is_one)
                own[low] = values[zero : zero + len(low)]
                own[up] = values[one : one + len(up)] | bit
                zero, one = zero + len(low), one + len(up)
            values = before
        return values


class _Encoder:
    """The tokenizers library behind a cache of pieces; encoded pieces are little-endian unsigned numbers."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary_ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.levels = max(1, max(vocabulary_ids.values()).bit_length())
        self.kind = "<u2" if self.levels <= 16 else "<u4"
        # Bytes of each id: a byte-level token has a letter per byte, a special one is its own text.
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.sizes = np.zeros(max(vocabulary_ids.values()) + 1, dtype=np.int64)
        for token, i in vocabulary_ids.items():
            self.sizes[i] = len(token.encode()) if token in special else len(token)
        # Only new pieces reach the library, so its own cache of words would never be hit.
        self.tokenizer.model._resize_cache(0)
        # Marks that this tokenizer parts from a letter, and that are in no special token.
        split = self.tokenizer.pre_tokenizer
        marks = [m for m in ",.;:!?" if split and len(split.pre_tokenize_str(f"a{m}")) == 2 and not any(m in t for t in special)]
        self.table = PieceTable(self._encode, CACHED_PIECES, "".join(marks).encode())

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces that begin with white space and end without it are encoded as one text, and cut again by bytes.

        Returns all ids, and per piece where its ids begin and how many they are.
        """
        joined = [i for i, p in enumerate(pieces) if p[:1] in (" ", "\n") and not p[-1].isspace()]
        starts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        parts, size = [np.zeros(0, self.kind)], 0
        for at in range(0, len(joined), _JOINED_PIECES):
            own = joined[at : at + _JOINED_PIECES]
            texts = [pieces[i] for i in own]
            ends = np.cumsum([len(t) if t.isascii() else len(t.encode()) for t in texts])
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, dtype=self.kind)
            cuts = np.concatenate([[0], np.searchsorted(np.cumsum(self.sizes[ids]), ends, side="right")])
            starts[own], lengths[own] = cuts[:-1] + size, np.diff(cuts)
            parts.append(ids)
            size += len(ids)
        alone = sorted(set(range(len(pieces))).difference(joined))
        encoded = self.tokenizer.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False)
        for i, one in zip(alone, encoded, strict=True):
            ids = np.array(one.ids, dtype=self.kind)
            starts[i], lengths[i] = size, len(ids)
            parts.append(ids)
            size += len(ids)
        return np.concatenate(parts), starts, lengths

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and how many each text has; a text's pieces have as many ids as the text."""
        return self.table.of_texts(texts)


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(vocabulary: str) -> _Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = _Encoder(vocabulary)
    return _ENCODERS[vocabulary]


_FILES = "partition int, shard int, n_ids long, doc_ids array<long>, file binary"


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> None:
    """Encode ``text`` in ascending ``doc_id`` order and write the shards' files below ``folder``.

    Null texts are empty and hold the end id only. A null id comes first; rows with the same id are
    ordered by a hash of their text. Partitions are ranges of ids, each cut into shards in order.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = plain.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made = _encoder(vocabulary)
        levels = max(made.levels, end_id.bit_length())
        names: list[int | None] = []
        held: list[np.ndarray] = []
        held_sizes: list[np.ndarray] = []
        size, start, shard = 0, 0, 0

        def closed() -> pa.RecordBatch:
            nonlocal size, start, shard
            ids = np.concatenate(held)
            ends = np.cumsum(np.concatenate(held_sizes))
            row = [[TaskContext.get().partitionId()], [shard], [len(ids)], [list(names)], [build(ids, ends, start, levels)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            shard, start, size = shard + 1, start + len(ids), 0
            for part in (names, held, held_sizes):
                part.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                names=["partition", "shard", "n_ids", "doc_ids", "file"],
            )

        for batch in batches:
            names_here = batch.column(0).to_pylist()
            ids, sizes = made.of_texts(batch.column(1))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < len(sizes):
                # Up to and with the document that fills the shard.
                stop = min(len(sizes), int(np.searchsorted(ends, ends[at] + shard_ids - size, side="left")))
                names += names_here[at:stop]
                held.append(ids[ends[at] : ends[stop]])
                held_sizes.append(sizes[at:stop])
                size += int(ends[stop] - ends[at])
                at = stop
                if size >= shard_ids:
                    yield closed()
        if names:
            yield closed()

    arrow_map(ordered, run, _FILES, rows=_BATCH_ROWS).write.parquet(folder)


def _starts(files: DataFrame) -> DataFrame:
    """Ids before each partition. Partitions are added up in blocks of 1000 first, so no window is long."""
    sizes = files.groupBy("partition").agg(F.sum("n_ids").alias("n")).withColumn("block", F.expr("partition div 1000"))
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("b"))
    before = F.coalesce(F.sum("b").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("block", before.alias("b"))
    inside = W.partitionBy("block").orderBy("partition").rowsBetween(W.unboundedPreceding, -1)
    own = sizes.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return own.join(blocks, "block").select("partition", (F.col("b") + F.col("own")).alias("before"))


_READ = "partition int, doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(files: DataFrame) -> DataFrame:
    """Per document its place and a checksum of its ids, read back from the shards' files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, names, data = (batch.column(i)[row].as_py() for i in range(3))
                shard = Shard(data)
                ids = shard.ids().astype("<u4")
                ends = shard.ends.tolist()
                begins = [0, *ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ends), pa.int32()),
                        pa.array(names, pa.int64()),
                        pa.array([shard.start + b for b in begins], pa.int64()),
                        pa.array([e - b for b, e in zip(begins, ends, strict=True)], pa.int64()),
                        pa.array([zlib.crc32(ids[b:e]) for b, e in zip(begins, ends, strict=True)], pa.int64()),
                    ],
                    names=["partition", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = arrow_map(files.select("partition", "doc_ids", "file"), run, _READ)
    before = written(_starts(files), "starts")
    whole = found.join(F.broadcast(before), "partition")  # one row of two numbers per partition of the files
    return whole.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_file_report(docs: DataFrame) -> DataFrame:
    """Write the shards of ``docs`` below the shared folder and read every document back from them."""
    folder = shared_dir(docs.sparkSession, "wavelet")
    write_shards(docs, folder)
    return read_documents(docs.sparkSession.read.parquet(folder))
