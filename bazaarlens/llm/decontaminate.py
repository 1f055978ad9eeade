"""Benchmark decontamination by Wu-Manber search for many word sequences at once.

Symbols are words. All patterns are cut to the length m of the shortest one of their class when the
tables are built: the shift table says how far the search may jump after a pair of words, the bucket
of a pair that ends a pattern lists the candidates, and each candidate is compared word by word.
Windows of the full size and the few items that are shorter are two classes, so that one short item
does not make every jump short.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .common import arrow_map, opened, sealed, texts_of

WINDOW_WORDS = 13
# Contaminated: hit words are at least a twentieth of the document's.
MIN_SHARE = 20
# Benchmark text of one search block (bytes): it bounds the tables that a task holds.
BLOCK_BYTES = 16 * 1024 * 1024
# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z: all other bytes become spaces.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class _Class:
    """Shift table and buckets of patterns that share a shortest length."""

    def __init__(self, patterns: dict[tuple[int, ...], set[int]]):
        self.least = min(map(len, patterns))
        self.block = min(2, self.least)
        self.jump = self.least - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for pattern, items in patterns.items():
            head = pattern[: self.least]
            for end in range(self.block, self.least + 1):
                key = head[end - 1] if self.block == 1 else (head[end - 2], head[end - 1])
                self.shift[key] = min(self.shift.get(key, self.jump), self.least - end)
            self.bucket.setdefault(key, []).append((pattern, items))

    def find(self, words: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        at, count, jump, shift = self.least - 1, len(words), self.jump, self.shift
        while at < count:
            key = words[at] if self.block == 1 else (words[at - 1], words[at])
            step = shift.get(key, jump)
            if step:
                at += step
                continue
            start = at - self.least + 1
            for pattern, items in self.bucket[key]:
                if tuple(words[start : start + len(pattern)]) == pattern:
                    yield start, start + len(pattern), items
            at += 1


class Search:
    """Windows of ``window`` words of all items; an item of fewer words, but not none, is one window."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int = WINDOW_WORDS):
        self.names: list[str] = []
        self.number: dict[bytes, int] = {}
        full: dict[tuple[int, ...], set[int]] = {}
        short: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            words = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words_of(text))
            if not words:
                continue
            item = len(self.names)
            self.names.append(name)
            if len(words) < window:
                short.setdefault(words, set()).add(item)
            for i in range(len(words) - window + 1):
                full.setdefault(words[i : i + window], set()).add(item)
        self.classes = [_Class(patterns) for patterns in (full, short) if patterns]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word ranges that occurring windows cover, and the numbers of their items."""
        number = self.number.get
        symbols = [number(w, 0) for w in words]
        ranges, items = [], set()
        for tables in self.classes:
            for start, end, found in tables.find(symbols):
                ranges.append((start, end))
                items |= found
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


FOUND = "_found"
_FOUND_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _blocks(benchmark: DataFrame, block_bytes: int) -> int:
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-size // block_bytes))


def _search_block(docs: DataFrame, items: list, window: int, first: bool) -> DataFrame:
    """Adds the column ``_found``, or merges further hits into it."""
    fields = [f for f in docs.schema.fields if f.name != FOUND]
    schema = T.StructType([*fields, T.StructField(FOUND, _FOUND_TYPE)])
    names = [f.name for f in fields]
    shared = docs.sparkSession.sparkContext.broadcast(items)
    kind = pa.struct(
        [("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, window)
        for batch in batches:
            known = [None] * batch.num_rows if first else batch.column(batch.schema.get_field_index(FOUND)).to_pylist()
            out = []
            for text, old in zip(texts_of(batch), known, strict=True):
                words = words_of(text)
                ranges, numbers = search.hits(words)
                items = {search.names[i] for i in numbers} - {None}
                if old:
                    ranges = merged([*ranges, *zip(old["starts"], old["ends"], strict=True)])
                    items |= set(old["items"])
                out.append(
                    {
                        "n_words": len(words),
                        "starts": [r[0] for r in ranges],
                        "ends": [r[1] for r in ranges],
                        "items": sorted(items),
                    }
                )
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, kind)], names=[*names, FOUND])

    return arrow_map(docs, run, schema)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``_found``: ``n_words``, the covered word ranges, and the items with occurring windows.

    The benchmark is searched in blocks of about ``block_bytes``: each block's tables are broadcast and
    every document passes all blocks in turn, without a shuffle; between two blocks the table is written. Null texts have no words. Items without
    words match nothing; items without id can hit words, but are not listed. Repeated items count once.
    """
    pieces = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    count = _blocks(pieces, block_bytes)
    numbered = pieces.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for block in range(count):
        rows = numbered.filter(F.col("_block") == block).drop("_block").collect()
        items = [(row["item_id"], row["text"].encode()) for row in rows]
        docs = _search_block(docs, items, window, block == 0)
        if block < count - 1:  # else one stage would hold the tables of all blocks
            docs = written(docs, "searched")
    return docs


def measures(found: DataFrame) -> DataFrame:
    """``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated`` in place of ``_found``."""
    hit = F.aggregate(
        F.zip_with(f"{FOUND}.ends", f"{FOUND}.starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x
    )
    items = F.col(f"{FOUND}.items")
    return (
        found.withColumn("n_words", F.col(f"{FOUND}.n_words"))
        .withColumn("n_hit", hit)
        .withColumn("items", items)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * MIN_SHARE >= F.col("n_words")))
        .drop(FOUND)
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they are."""
    n_hit = F.aggregate(
        F.zip_with(f"{FOUND}.ends", f"{FOUND}.starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x
    )
    bad = (n_hit > 0) & (n_hit * MIN_SHARE >= F.col(f"{FOUND}.n_words"))
    return opened(search(sealed(docs), benchmark).filter(~bad), docs)


def items_digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
