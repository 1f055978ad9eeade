"""Line de-duplication over overlapping windows of three lines.

Windows run over the lines that have a word; blank lines between them do not count and are kept. Windows
are hashed (128 bits) where the text is; only hashes and positions are shuffled. The first occurrence of
a window is the one with the smallest document (``doc_id``, null last, then a hash of the text) and
position. Every line that a later occurrence covers is removed. A removed line always has an equal line
earlier, so each line's content stays somewhere. Rows with equal id and text are one document: they get
the same decision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .common import arrow_map, opened, sealed, texts_of

WINDOW_LINES = 3
_KEY = "_text_key"
_LATER = "_later"
_WINDOWS = "doc_id long, text_key long, high long, low long, at int"


def _text_key(text: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))


def _lines(text: bytes) -> tuple[list[bytes], list[int]]:
    """All lines, and the indexes of those with a word."""
    lines = text.split(b"\n")
    return lines, [i for i, line in enumerate(lines) if line.strip()]


def windows(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``doc_id``, ``text_key``, the window's hash in ``high`` and ``low``, and ``at``, the number of its first line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out_id, out_key, out_at, digests = [], [], [], []
            for doc, text in zip(ids, texts_of(batch), strict=True):
                lines, full = _lines(text)
                count = len(full) - size + 1
                if count < 1:
                    continue
                key = _text_key(text)
                for i in range(count):
                    joined = b"\n".join([lines[j] for j in full[i : i + size]])
                    digests.append(xxhash.xxh3_128_digest(joined))
                out_id += [doc] * count
                out_key += [key] * count
                out_at += range(count)
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_id, pa.int64()),
                    pa.array(out_key, pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(out_at, pa.int32()),
                ],
                names=["doc_id", "text_key", "high", "low", "at"],
            )

    return arrow_map(docs.select("doc_id", "text"), run, _WINDOWS)


def later_windows(found: DataFrame) -> DataFrame:
    """Per document (``doc_id``, ``text_key``) the positions of windows that occurred before."""
    found = found.distinct()  # repeated rows are one document
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key", "at")
    first = found.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    repeated = first.filter("n > 1").select("high", "low", "first")
    # Both sides grow with the documents: they are always merged, never broadcast.
    later = found.join(repeated.hint("merge"), ["high", "low"]).filter(place != F.col("first"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_list("at").alias("later"))


def remove_lines(text: bytes, later: list[int], size: int = WINDOW_LINES) -> tuple[bytes, int, int]:
    """The text without the lines that the windows at ``later`` cover, its lines with a word, and how many went."""
    lines, full = _lines(text)
    gone = {full[i] for at in later for i in range(at, at + size)}
    return b"\n".join([line for i, line in enumerate(lines) if i not in gone]), len(full), len(gone)


def _marked(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` with the positions of its later windows, joined by id and hash of the text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(_KEY, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([_text_key(t) for t in texts_of(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, _KEY])

    found = written(windows(docs, size), "windows")
    later = written(later_windows(found), "later").select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), F.col("later").alias(_LATER)
    )
    keyed = arrow_map(docs, run, schema)
    same = keyed["doc_id"].eqNullSafe(F.col("_doc")) & (keyed[_KEY] == F.col("_key"))
    return keyed.join(later.hint("merge"), same, "left").drop("_doc", "_key", _KEY)


def _rewritten(marked: DataFrame, fields: list[T.StructField], counts: bool, size: int) -> DataFrame:
    names = [f.name for f in fields]
    extra = [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())] if counts else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            empty = batch.column(at).is_null().to_pylist()
            later = batch.column(batch.schema.get_field_index(_LATER)).to_pylist()
            done = [remove_lines(t, w or [], size) for t, w in zip(texts_of(batch), later, strict=True)]
            texts = pa.array([None if e else d[0].decode() for e, d in zip(empty, done, strict=True)], pa.string())
            columns = [texts if n == "text" else batch.column(batch.schema.get_field_index(n)) for n in names]
            if counts:
                columns += [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *[f.name for f in extra]])

    return arrow_map(marked, run, T.StructType([*fields, *extra]))


def dedup_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with every later occurrence of a window cut from ``text``; other columns as they are.

    No row goes: a text may become empty. Null texts stay null, texts of fewer lines than a window stay.
    """
    plain = sealed(docs)
    return opened(_rewritten(_marked(plain, size), plain.schema.fields, False, size), docs)


def line_report(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``doc_id``, the cut ``text``, ``n_lines`` (lines with a word before) and ``n_removed``."""
    plain = docs.select("doc_id", "text")
    return _rewritten(_marked(plain, size), plain.schema.fields, True, size)
